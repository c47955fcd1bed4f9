"""Registered lookup, paging and report queries (B1-B10) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.operators import lookup as L
from tallybook.plans.inputs import Inputs
from tallybook.plans.registry import register

# Lookup keys: every user's account reference plus references that do not exist.
_KEYS_SQL = """
SELECT DISTINCT concat('acct_C', cast(user_id AS string)) AS external_ref FROM events
UNION SELECT DISTINCT concat('acct_C', cast(user_id + 100000 AS string)) FROM events
"""


@register("lookup_accounts", oracle=f"""
WITH k AS ({_KEYS_SQL})
SELECT k.external_ref, a.id AS r_id, a.account_number AS r_account_number,
       a.status AS r_status, a.id IS NOT NULL AS found
FROM k LEFT JOIN fx_accounts a ON a.external_ref = k.external_ref
""")
def q_lookup_accounts(spark, d):
    x = Inputs(spark, d)
    keys = x.table("events").select(
        F.concat(F.lit("acct_C"), F.col("user_id").cast("string")).alias("external_ref")).union(
        x.table("events").select(F.concat(F.lit("acct_C"), (F.col("user_id") + 100000)
                                          .cast("string")).alias("external_ref"))).distinct()
    out = L.lookup(x.accounts, keys, "external_ref")
    return out.select("external_ref", "r_id", "r_account_number", "r_status", "found")


@register("lookup_webhooks_by_external_id", oracle="""
WITH k AS (SELECT DISTINCT provider, external_event_id FROM fx_webhooks
           WHERE external_event_id IS NOT NULL),
r AS (SELECT provider, external_event_id, min(id) AS id FROM fx_webhooks
      GROUP BY provider, external_event_id)
SELECT k.provider, k.external_event_id, r.id AS r_id, r.id IS NOT NULL AS found
FROM k LEFT JOIN r ON r.provider = k.provider AND r.external_event_id = k.external_event_id
""")
def q_lookup_webhooks(spark, d):
    x = Inputs(spark, d)
    hooks = x.raw("fx_webhooks")
    keys = hooks.filter(F.col("external_event_id").isNotNull()).select(
        "provider", "external_event_id").distinct()
    out = L.lookup(hooks, keys, ["provider", "external_event_id"], unique=False)
    return out.select("provider", "external_event_id", "r_id", "found")


@register("accounts_by_ids", oracle="""
SELECT id, status, currency_code FROM fx_accounts
WHERE id IN (SELECT source_account_id FROM fx_ops)
""")
def q_accounts_by_ids(spark, d):
    x = Inputs(spark, d)
    ids = x.ops.select(F.col("source_account_id").alias("id"))
    return L.accounts_by_ids(x.accounts, ids).select("id", "status", "currency_code")


@register("balances_by_ids", oracle="""
SELECT account_id, available_balance, version FROM fx_projections
WHERE currency_code = 'NGN' AND balance_kind = 'available'
  AND account_id IN (SELECT source_account_id FROM fx_ops)
""")
def q_balances_by_ids(spark, d):
    x = Inputs(spark, d)
    ids = x.ops.select(F.col("source_account_id").alias("id"))
    return L.balances_by_ids(x.projections, ids, "NGN", "available").select(
        "account_id", "available_balance", "version")


@register("list_page", oracle="""
SELECT id, external_ref, created_at FROM fx_customers
ORDER BY created_at DESC, id DESC LIMIT 50 OFFSET 100
""")
def q_list_page(spark, d):
    x = Inputs(spark, d)
    return L.list_page(x.customers, limit=50, offset=100).select("id", "external_ref",
                                                                 "created_at")


@register("list_page_capped", oracle="""
SELECT id, transaction_ref FROM fx_journal ORDER BY created_at DESC, id DESC LIMIT 1000
""")
def q_list_page_capped(spark, d):
    x = Inputs(spark, d)
    return L.list_page(x.journal, limit=5000).select("id", "transaction_ref")


@register("list_page_per_customer", oracle="""
WITH r AS (SELECT id, customer_id, created_at,
                  cast(row_number() OVER (PARTITION BY customer_id
                                          ORDER BY created_at DESC, id DESC) AS integer) AS page_rank
           FROM fx_transfers)
SELECT id, customer_id, created_at, page_rank FROM r WHERE page_rank > 1 AND page_rank <= 4
""")
def q_list_page_per_customer(spark, d):
    x = Inputs(spark, d)
    return L.list_page_per_key(x.transfers, "customer_id", limit=3, offset=1).select(
        "id", "customer_id", "created_at", "page_rank")


@register("lines_for_transactions", oracle="""
SELECT l.id, l.journal_transaction_id, l.line_number, l.amount FROM fx_lines l
WHERE l.journal_transaction_id IN (SELECT id FROM fx_journal WHERE status = 'pending')
""")
def q_lines_for_transactions(spark, d):
    x = Inputs(spark, d)
    return L.lines_for_transactions(x.lines, x.journal.filter(F.col("status") == "pending")) \
        .select("id", "journal_transaction_id", "line_number", "amount")


@register("active_holds", oracle="""
SELECT id, account_id, remaining_amount, created_at FROM fx_holds
WHERE status = 'active' AND account_id IN (SELECT id FROM fx_accounts WHERE status = 'active')
""")
def q_active_holds(spark, d):
    x = Inputs(spark, d)
    return L.active_holds(x.holds, accounts=x.accounts.filter(F.col("status") == "active")) \
        .select("id", "account_id", "remaining_amount", "created_at")


@register("balances_report", oracle="""
SELECT p.account_id, p.currency_code AS currency, p.balance_kind,
       COALESCE(cast(p.ledger_balance AS string), '0.00') AS ledger_amount,
       COALESCE(cast(p.available_balance AS string), '0.00') AS available_amount,
       COALESCE(cast(p.held_balance AS string), '0.00') AS held_amount,
       p.currency_code AS held_currency, p.computed_at AS as_of
FROM fx_projections p JOIN fx_accounts a ON a.id = p.account_id
""")
def q_balances_report(spark, d):
    x = Inputs(spark, d)
    rep, _ = L.balances_report(x.projections, x.accounts)
    return rep.select("account_id", "currency", "balance_kind",
                      F.col("ledger.amount").alias("ledger_amount"),
                      F.col("available.amount").alias("available_amount"),
                      F.col("held.amount").alias("held_amount"),
                      F.col("held.currency").alias("held_currency"), "as_of")


@register("transfer_report", oracle="""
SELECT t.id, t.status, j.jid AS journal_transaction_id,
       COALESCE(cast(t.amount AS string), '0.00') AS amount,
       COALESCE(cast(t.fee_amount AS string), '0.00') AS fee
FROM fx_transfers t LEFT JOIN (SELECT transfer_request_id, min(id) AS jid FROM fx_journal
                               GROUP BY transfer_request_id) j ON j.transfer_request_id = t.id
""")
def q_transfer_report(spark, d):
    x = Inputs(spark, d)
    rep = L.transfer_report(x.transfers, x.journal)
    return rep.select("id", "status", "journal_transaction_id",
                      F.get_json_object("response", "$.amount.amount").alias("amount"),
                      F.get_json_object("response", "$.fee.amount").alias("fee"))


@register("hold_report", oracle="""
SELECT id, account_id, status, cast(amount AS string) AS amount,
       cast(remaining_amount AS string) AS remaining, cast(captured_amount AS string) AS captured,
       cast(released_amount AS string) AS released, currency_code AS currency, expires_at
FROM fx_holds
""")
def q_hold_report(spark, d):
    rep = L.hold_report(Inputs(spark, d).holds)
    return rep.select("id", "account_id", "status", F.col("amount.amount").alias("amount"),
                      F.col("remaining.amount").alias("remaining"),
                      F.col("captured.amount").alias("captured"),
                      F.col("released.amount").alias("released"),
                      F.col("amount.currency").alias("currency"), "expires_at")


@register("funding_report", oracle="""
WITH c AS (SELECT journal_transaction_id, arg_min(account_id, line_number) AS account_id,
                  arg_min(amount, line_number) AS amount,
                  arg_min(currency_code, line_number) AS currency_code
           FROM fx_lines WHERE side = 'credit' GROUP BY journal_transaction_id)
SELECT j.id AS journal_transaction_id, j.entry_type, j.status,
       COALESCE(cast(c.amount AS string), '0.00') AS amount, c.currency_code AS currency,
       c.account_id, j.posted_at, j.source_event_id AS external_reference
FROM fx_journal j LEFT JOIN c ON c.journal_transaction_id = j.id
WHERE j.entry_type = 'deposit'
""")
def q_funding_report(spark, d):
    x = Inputs(spark, d)
    rep = L.funding_report(x.journal, x.lines)
    return rep.select("journal_transaction_id", "entry_type", "status",
                      F.col("amount.amount").alias("amount"),
                      F.col("amount.currency").alias("currency"), "account_id", "posted_at",
                      "external_reference")


@register("user_report", oracle="""
SELECT id, external_ref, full_name, email, phone, status, created_at, updated_at FROM fx_customers
""")
def q_user_report(spark, d):
    return L.user_report(Inputs(spark, d).customers)


@register("account_report", oracle="""
SELECT id, customer_id, external_ref, account_number, account_type, status, currency_code,
       ledger_normal_side, opened_at, closed_at, created_at FROM fx_accounts
""")
def q_account_report(spark, d):
    return L.account_report(Inputs(spark, d).accounts)


@register("lookup_customers_by_ref", oracle="""
WITH k AS (SELECT DISTINCT concat('cust_', cast(o_custkey AS string)) AS external_ref FROM orders
           UNION SELECT DISTINCT concat('cust_', cast(o_custkey + 1000000 AS string)) FROM orders)
SELECT k.external_ref, c.id AS r_id, c.status AS r_status, c.id IS NOT NULL AS found
FROM k LEFT JOIN fx_customers c ON c.external_ref = k.external_ref
""")
def q_lookup_customers_by_ref(spark, d):
    x = Inputs(spark, d)
    o = x.table("orders")
    keys = o.select(F.concat(F.lit("cust_"), F.col("o_custkey").cast("string"))
                    .alias("external_ref")).union(
        o.select(F.concat(F.lit("cust_"), (F.col("o_custkey") + 1000000).cast("string"))
                 .alias("external_ref"))).distinct()
    return L.lookup(x.customers, keys, "external_ref").select("external_ref", "r_id", "r_status",
                                                             "found")


@register("lookup_journal_by_ref", oracle="""
WITH k AS (SELECT DISTINCT concat('REF', cast(l_orderkey AS string)) AS transaction_ref
           FROM lineitem)
SELECT k.transaction_ref, j.id AS r_id, j.status AS r_status, j.id IS NOT NULL AS found
FROM k LEFT JOIN fx_journal j ON j.transaction_ref = k.transaction_ref
""")
def q_lookup_journal_by_ref(spark, d):
    x = Inputs(spark, d)
    keys = x.table("lineitem").select(
        F.concat(F.lit("REF"), F.col("l_orderkey").cast("string")).alias("transaction_ref")
    ).distinct()
    return L.lookup(x.journal, keys, "transaction_ref").select("transaction_ref", "r_id",
                                                              "r_status", "found")


@register("lookup_projection", oracle="""
WITH k AS (SELECT DISTINCT concat('C', cast(o_custkey AS string)) AS account_id,
                  'NGN' AS currency_code, 'available' AS balance_kind FROM orders)
SELECT k.account_id, k.currency_code, k.balance_kind, p.available_balance AS r_available_balance,
       p.version AS r_version, p.account_id IS NOT NULL AS found
FROM k LEFT JOIN fx_projections p ON p.account_id = k.account_id
 AND p.currency_code = k.currency_code AND p.balance_kind = k.balance_kind
""")
def q_lookup_projection(spark, d):
    x = Inputs(spark, d)
    keys = x.table("orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("account_id"),
        F.lit("NGN").alias("currency_code"), F.lit("available").alias("balance_kind")).distinct()
    out = L.lookup(x.projections, keys, ["account_id", "currency_code", "balance_kind"])
    return out.select("account_id", "currency_code", "balance_kind", "r_available_balance",
                      "r_version", "found")


@register("lookup_idempotency_key", oracle="""
WITH k AS (SELECT DISTINCT scope, idempotency_key FROM fx_request_bodies)
SELECT k.scope, k.idempotency_key, i.id AS r_id, i.response_code AS r_response_code,
       i.id IS NOT NULL AS found
FROM k LEFT JOIN fx_idem_keys i ON i.scope = k.scope AND i.idempotency_key = k.idempotency_key
""")
def q_lookup_idempotency_key(spark, d):
    from tallybook.schemas import IDEMPOTENCY_KEYS, conform
    x = Inputs(spark, d)
    keys = x.raw("fx_request_bodies").select("scope", "idempotency_key").distinct()
    stored = conform(x.raw("fx_idem_keys"), IDEMPOTENCY_KEYS)
    out = L.lookup(stored, keys, ["scope", "idempotency_key"])
    return out.select("scope", "idempotency_key", "r_id", "r_response_code", "found")
