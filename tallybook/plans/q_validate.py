"""Registered validation queries (C1-C10) with their DuckDB oracles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook import schemas as S
from tallybook.operators import constraints as K
from tallybook.operators import validate as V
from tallybook.plans.inputs import Inputs, conform
from tallybook.plans.registry import register
from tallybook.sources.messages import parse_requests

_JSON_OBJ = "CASE WHEN json_valid({c}) THEN json_type({c}) = 'OBJECT' ELSE false END"


def _union(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def _parsed_requests_sql() -> str:
    fields = ["idempotency_key_id", "customer_id", "source_account_id", "destination_account_id",
              "currency_code", "source_system", "provider", "client_reference",
              "external_reference", "description"]
    ext = ",\n       ".join(f"json_extract_string(body, '$.{f}') AS {f}" for f in fields)
    return f"""
SELECT request_id, kind, {ext},
       json_extract_string(body, '$.amount') AS amount_text,
       json_extract_string(body, '$.fee_amount') AS fee_text,
       TRY_CAST(trim(json_extract_string(body, '$.amount')) AS decimal(20,8)) AS amount,
       TRY_CAST(trim(json_extract_string(body, '$.fee_amount')) AS decimal(20,8)) AS fee_amount,
       {_JSON_OBJ.format(c='body')} AS ok_json
FROM fx_request_bodies"""


def _required_sql() -> str:
    parts = []
    for kind in ("deposit", "transfer", "withdrawal"):
        flags = ", ".join(f"CASE WHEN COALESCE({f}, '') = '' THEN '{f}' END"
                          if f not in ("amount", "fee_amount")
                          else f"CASE WHEN {f} IS NULL THEN '{f}' END"
                          for f in V.REQUIRED_FIELDS[kind])
        parts.append(f"SELECT request_id, concat_ws(', ', {flags}) AS m FROM good "
                     f"WHERE kind = '{kind}'")
    body = "\nUNION ALL\n".join(parts)
    return f"""
WITH p AS ({_parsed_requests_sql()}),
good AS (SELECT * FROM p WHERE ok_json
         AND NOT (COALESCE(trim(amount_text), '') <> '' AND amount IS NULL)
         AND NOT (COALESCE(trim(fee_text), '') <> '' AND fee_amount IS NULL)),
m AS ({body})
SELECT 'required' AS rule, k.kind AS table_name, m.request_id AS key,
       concat('missing: ', m.m) AS detail
FROM m JOIN fx_request_bodies k ON k.request_id = m.request_id
WHERE m.m <> ''
"""


@register("check_required_violations", oracle=_required_sql())
def q_check_required(spark, d):
    x = Inputs(spark, d)
    parsed, _ = parse_requests(x.raw("fx_request_bodies"))
    outs = [V.check_required(parsed.filter(F.col("kind") == k), k)[1]
            for k in ("deposit", "transfer", "withdrawal")]
    return _union(outs)


# Oracle text of the domain rules for the tables the query checks.
_DOMAIN_SQL = {
    "customers": ("fx_customers", [
        ("external_ref_not_null", "external_ref IS NOT NULL"),
        ("full_name_not_null", "full_name IS NOT NULL"),
        ("status_not_null", "status IS NOT NULL"),
        ("metadata_not_null", "metadata IS NOT NULL"),
        ("status_domain", "status IN ('active', 'suspended', 'closed')"),
        ("metadata_is_object", _JSON_OBJ.format(c="metadata"))]),
    "accounts": ("fx_accounts", [
        *[(f"{c}_not_null", f"{c} IS NOT NULL") for c in [
            "customer_id", "external_ref", "account_number", "account_type", "status",
            "currency_code", "ledger_normal_side", "metadata"]],
        ("currency_code_check", "regexp_matches(currency_code, '^[A-Z]{3}$')"),
        ("account_type_domain", "account_type IN ('system', 'settlement', 'fee', 'customer')"),
        ("status_domain", "status IN ('pending', 'active', 'frozen', 'closed')"),
        ("normal_side_domain", "ledger_normal_side IN ('debit', 'credit')"),
        ("metadata_is_object", _JSON_OBJ.format(c="metadata")),
        ("closed_at_requires_closed",
         "(closed_at IS NULL AND status <> 'closed') OR (closed_at IS NOT NULL)")]),
    "journal_lines": ("fx_lines_bad", [
        *[(f"{c}_not_null", f"{c} IS NOT NULL") for c in [
            "journal_transaction_id", "line_number", "account_id", "side", "amount",
            "currency_code", "balance_kind"]],
        ("amount_positive", "amount > 0"),
        ("currency_code_check", "regexp_matches(currency_code, '^[A-Z]{3}$')"),
        ("side_domain", "side IN ('debit', 'credit')"),
        ("balance_kind_domain", "balance_kind IN ('ledger', 'available', 'held')"),
        ("metadata_is_object", _JSON_OBJ.format(c="metadata"))]),
    "funds_holds": ("fx_holds", [
        *[(f"{c}_not_null", f"{c} IS NOT NULL") for c in [
            "account_id", "idempotency_key_id", "status", "currency_code", "amount",
            "remaining_amount"]],
        ("amount_positive", "amount > 0"),
        ("remaining_nonnegative", "remaining_amount >= 0"),
        ("released_nonnegative", "released_amount >= 0"),
        ("captured_nonnegative", "captured_amount >= 0"),
        ("components_sum", "remaining_amount + released_amount + captured_amount = amount"),
        ("currency_code_check", "regexp_matches(currency_code, '^[A-Z]{3}$')"),
        ("status_domain", "status IN ('active', 'released', 'consumed', 'expired')")]),
    "transfer_requests": ("fx_transfers", [
        *[(f"{c}_not_null", f"{c} IS NOT NULL") for c in [
            "idempotency_key_id", "customer_id", "source_account_id", "destination_account_id",
            "currency_code", "amount", "fee_amount", "status"]],
        ("amount_positive", "amount > 0"),
        ("fee_nonnegative", "fee_amount >= 0"),
        ("currency_code_check", "regexp_matches(currency_code, '^[A-Z]{3}$')"),
        ("status_domain", "status IN ('pending', 'reversed', 'posted', 'failed')"),
        ("metadata_is_object", _JSON_OBJ.format(c="metadata")),
        ("distinct_accounts", "source_account_id <> destination_account_id")]),
}


def _domains_sql() -> str:
    parts = []
    for table, (fx, rules) in _DOMAIN_SQL.items():
        for name, cond in rules:
            parts.append(f"SELECT '{name}' AS rule, '{table}' AS table_name, id AS key, "
                         f"cast(NULL AS string) AS detail FROM {fx} "
                         f"WHERE NOT COALESCE({cond}, true)")
    return "\nUNION ALL\n".join(parts)


@register("check_domains_violations", oracle=_domains_sql())
def q_check_domains(spark, d):
    x = Inputs(spark, d)
    tables = {"customers": x.customers, "accounts": x.accounts, "journal_lines": x.lines_bad,
              "funds_holds": x.holds, "transfer_requests": x.transfers}
    return _union([V.check_domains(df, t)[1] for t, df in tables.items()])


@register("check_unique_violations", oracle="""
SELECT 'unique_email' AS rule, 'customers' AS table_name, lower(email) AS key,
       concat('rows: ', cast(count(*) AS string)) AS detail
FROM fx_customers WHERE email IS NOT NULL GROUP BY lower(email) HAVING count(*) > 1
UNION ALL
SELECT 'unique_external_ref', 'customers', external_ref, concat('rows: ', cast(count(*) AS string))
FROM fx_customers WHERE external_ref IS NOT NULL GROUP BY external_ref HAVING count(*) > 1
UNION ALL
SELECT 'unique_source_system_statement_date_external_reference', 'statement',
       concat_ws('|', source_system, cast(statement_date AS string), external_reference),
       concat('rows: ', cast(count(*) AS string))
FROM fx_statement GROUP BY source_system, statement_date, external_reference HAVING count(*) > 1
""")
def q_check_unique(spark, d):
    x = Inputs(spark, d)
    return _union([
        V.check_unique(x.customers, ["email"], "customers", case_insensitive=["email"])[1],
        V.check_unique(x.customers, ["external_ref"], "customers")[1],
        V.check_unique(x.raw("fx_statement"),
                       ["source_system", "statement_date", "external_reference"], "statement")[1],
    ])


@register("check_references_violations", oracle="""
WITH lines AS (SELECT id, journal_transaction_id, account_id FROM fx_lines
               UNION ALL SELECT id, journal_transaction_id, account_id FROM fx_reversal_lines)
SELECT 'fk_account_id' AS rule, 'journal_lines' AS table_name, id AS key, account_id AS detail
FROM lines WHERE account_id IS NOT NULL AND account_id NOT IN (SELECT id FROM fx_accounts)
UNION ALL
SELECT 'fk_journal_transaction_id', 'journal_lines', id, journal_transaction_id
FROM lines WHERE journal_transaction_id NOT IN (SELECT id FROM fx_journal)
UNION ALL
SELECT 'fk_account_id', 'funds_holds', id, account_id
FROM fx_holds WHERE account_id NOT IN (SELECT id FROM fx_accounts)
UNION ALL
SELECT 'fk_destination_account_id', 'transfer_requests', id, destination_account_id
FROM fx_transfers WHERE destination_account_id NOT IN (SELECT id FROM fx_accounts)
UNION ALL
SELECT 'fk_customer_id', 'accounts', id, customer_id
FROM fx_accounts WHERE customer_id NOT IN (SELECT id FROM fx_customers)
""")
def q_check_references(spark, d):
    x = Inputs(spark, d)
    lines = x.lines.unionByName(conform(x.raw("fx_reversal_lines"), S.JOURNAL_LINES))
    return _union([
        V.check_references(lines, "account_id", x.accounts, "id", "journal_lines")[1],
        V.check_references(lines, "journal_transaction_id", x.journal, "id", "journal_lines")[1],
        V.check_references(x.holds, "account_id", x.accounts, "id", "funds_holds")[1],
        V.check_references(x.transfers, "destination_account_id", x.accounts, "id",
                           "transfer_requests")[1],
        V.check_references(x.accounts, "customer_id", x.customers, "id", "accounts")[1],
    ])


@register("check_double_entry_violations", oracle="""
WITH s AS (
  SELECT journal_transaction_id, count(*) AS n,
         SUM(CASE WHEN side = 'debit' THEN amount ELSE 0 END) AS dr,
         SUM(CASE WHEN side = 'credit' THEN amount ELSE 0 END) AS cr
  FROM fx_lines_bad GROUP BY journal_transaction_id)
SELECT CASE WHEN n < 2 THEN 'min_two_lines' ELSE 'unbalanced' END AS rule,
       'journal_lines' AS table_name, journal_transaction_id AS key,
       concat('lines=', cast(n AS string), ' debits=', cast(cast(dr AS decimal(38,8)) AS string),
              ' credits=', cast(cast(cr AS decimal(38,8)) AS string)) AS detail
FROM s WHERE n < 2 OR dr <> cr
""")
def q_check_double_entry(spark, d):
    return V.check_double_entry(Inputs(spark, d).lines_bad)[1]


@register("check_double_entry_valid", oracle="""
WITH s AS (
  SELECT journal_transaction_id, count(*) AS n,
         SUM(CASE WHEN side = 'debit' THEN amount ELSE 0 END) AS dr,
         SUM(CASE WHEN side = 'credit' THEN amount ELSE 0 END) AS cr
  FROM fx_lines_bad GROUP BY journal_transaction_id)
SELECT l.id, l.journal_transaction_id, l.line_number, l.amount FROM fx_lines_bad l
JOIN s ON s.journal_transaction_id = l.journal_transaction_id WHERE s.n >= 2 AND s.dr = s.cr
""")
def q_check_double_entry_valid(spark, d):
    return V.check_double_entry(Inputs(spark, d).lines_bad)[0].select(
        "id", "journal_transaction_id", "line_number", "amount")


@register("check_legs_violations", oracle="""
WITH s AS (
  SELECT journal_transaction_id,
         SUM(CASE WHEN side = 'debit' THEN COALESCE(amount, 0) ELSE 0 END) AS dr,
         SUM(CASE WHEN side = 'credit' THEN COALESCE(amount, 0) ELSE 0 END) AS cr,
         bool_or(NOT COALESCE(side IN ('debit', 'credit'), false)) AS bad_side
  FROM fx_lines_bad GROUP BY journal_transaction_id)
SELECT CASE WHEN bad_side THEN 'invalid_side' ELSE 'unbalanced' END AS rule,
       'legs' AS table_name, journal_transaction_id AS key,
       CASE WHEN bad_side THEN NULL
            ELSE concat('remainder ', cast(cast(dr - cr AS decimal(38,8)) AS string)) END AS detail
FROM s WHERE bad_side OR dr <> cr
""")
def q_check_legs(spark, d):
    return V.check_legs(Inputs(spark, d).lines_bad)[1]


@register("check_eligibility", oracle="""
SELECT r.request_id, 'deposit' AS kind,
       CASE WHEN c.id IS NULL THEN 'customer not found'
            WHEN c.status <> 'active' THEN 'customer is not active'
            WHEN COALESCE(a.status, '') <> 'active' THEN 'destination account is not active'
            WHEN COALESCE(a.currency_code, '') <> r.currency_code THEN 'currency code mismatch'
       END AS reason
FROM fx_deposits r LEFT JOIN fx_customers c ON c.id = r.customer_id
LEFT JOIN fx_accounts a ON a.id = r.destination_account_id
UNION ALL
SELECT r.request_id, 'withdrawal',
       CASE WHEN c.id IS NULL THEN 'customer not found'
            WHEN a.id IS NULL THEN 'source account not found'
            WHEN a.status <> 'active' THEN 'source account is not active'
            WHEN a.currency_code <> r.currency_code THEN 'currency code mismatch' END
FROM fx_withdrawals r LEFT JOIN fx_customers c ON c.id = r.customer_id
LEFT JOIN fx_accounts a ON a.id = r.source_account_id
UNION ALL
SELECT r.id, 'transfer',
       CASE WHEN c.id IS NULL THEN 'customer not found'
            WHEN COALESCE(s.currency_code, '') <> r.currency_code
              OR COALESCE(t.currency_code, '') <> r.currency_code THEN 'currency code mismatch' END
FROM fx_transfers r LEFT JOIN fx_customers c ON c.id = r.customer_id
LEFT JOIN fx_accounts s ON s.id = r.source_account_id
LEFT JOIN fx_accounts t ON t.id = r.destination_account_id
""")
def q_check_eligibility(spark, d):
    x = Inputs(spark, d)
    dep = V.check_eligibility(x.deposits, x.customers, x.accounts, "deposit")
    wd = V.check_eligibility(x.withdrawals, x.customers, x.accounts, "withdrawal")
    tr = V.check_eligibility(x.transfers, x.customers, x.accounts, "transfer")
    return _union([
        dep.select("request_id", F.lit("deposit").alias("kind"), "reason"),
        wd.select("request_id", F.lit("withdrawal").alias("kind"), "reason"),
        tr.select(F.col("id").alias("request_id"), F.lit("transfer").alias("kind"), "reason")])


@register("check_append_only", oracle="""
SELECT CASE WHEN a.id IS NULL THEN 'deleted' ELSE 'updated' END AS rule,
       'journal_lines' AS table_name, b.id AS key, cast(NULL AS string) AS detail
FROM fx_lines b LEFT JOIN fx_lines_after a ON a.id = b.id
WHERE a.id IS NULL
   OR b.amount IS DISTINCT FROM a.amount OR b.side IS DISTINCT FROM a.side
   OR b.account_id IS DISTINCT FROM a.account_id
   OR b.journal_transaction_id IS DISTINCT FROM a.journal_transaction_id
   OR b.line_number IS DISTINCT FROM a.line_number
   OR b.currency_code IS DISTINCT FROM a.currency_code
   OR b.balance_kind IS DISTINCT FROM a.balance_kind
   OR b.created_at IS DISTINCT FROM a.created_at
""")
def q_check_append_only(spark, d):
    x = Inputs(spark, d)
    return V.check_append_only(x.lines, conform(x.raw("fx_lines_after"), S.JOURNAL_LINES))


@register("verify_provider_token", oracle="""
SELECT c.hook_id, c.provider,
       CASE WHEN p.provider IS NULL THEN 'unknown provider'
            WHEN c.token IS NULL OR c.token <> p.secret THEN 'invalid signature' END AS reason
FROM fx_callbacks c LEFT JOIN fx_providers p ON p.provider = c.provider
""")
def q_verify_provider_token(spark, d):
    x = Inputs(spark, d)
    ok, bad = V.verify_provider_token(x.raw("fx_callbacks"), x.raw("fx_providers"))
    return (ok.select("hook_id", "provider", F.lit(None).cast("string").alias("reason"))
            .unionByName(bad.select("hook_id", "provider", "reason")))


@register("sufficient_funds", oracle="""
SELECT t.id, cast(COALESCE(p.available_balance, 0) AS decimal(20,8)) AS available_balance,
       cast(t.amount + t.fee_amount AS decimal(20,8)) AS needed,
       COALESCE(p.available_balance, 0) >= t.amount + t.fee_amount AS sufficient
FROM fx_transfers t LEFT JOIN fx_projections p
  ON p.account_id = t.source_account_id AND p.currency_code = t.currency_code
 AND p.balance_kind = 'available'
""")
def q_sufficient_funds(spark, d):
    x = Inputs(spark, d)
    return V.sufficient_funds(x.transfers, x.projections, "transfer").select(
        "id", "available_balance", "needed", "sufficient")


def _catalogue_sql() -> str:
    """Every unique key by GROUP BY, every foreign key by NOT EXISTS."""
    out = []
    for table, keys in K.UNIQUE.items():
        for cols in keys:
            low = [f"lower({c})" if (table, c) in K.CASELESS else c for c in cols]
            there = " AND ".join(f"{c} IS NOT NULL" for c in cols)
            text = f"concat_ws('|', {', '.join(low)})" if len(low) > 1 else f"cast({low[0]} AS string)"
            out.append(f"SELECT 'unique_{'_'.join(cols)}' AS rule, '{table}' AS table_name, {text} AS key, count(*) AS rows "
                       f"FROM fx_cat_{table} WHERE {there} GROUP BY {', '.join(low)} HAVING count(*) > 1")
    for table, fks in K.REFERENCES.items():
        for col, parent in fks.items():
            out.append(f"SELECT 'fk_{col}', '{table}', {col}, count(*) FROM fx_cat_{table} c WHERE {col} IS NOT NULL "
                       f"AND NOT EXISTS (SELECT 1 FROM fx_cat_{parent} p WHERE p.id = c.{col}) GROUP BY {col}")
    return "\nUNION ALL\n".join(out)


@register("check_catalogue", oracle=_catalogue_sql())
def q_check_catalogue(spark, d):
    """All 17 unique keys and 22 foreign keys, one pass over each of the tables they constrain."""
    x = Inputs(spark, d)
    names = [*K.UNIQUE, "outbox_events", "reconciliation_batches"]
    return K.check_ledger({t: x.raw(f"fx_cat_{t}") for t in names}, domains=False)[0]


# Oracle text of the domain rules of the other tables, and their fixtures with broken rows.
_OBJ = lambda c: f"({c} IS NULL OR {_JSON_OBJ.format(c=c)})"
_NN = lambda *cs: [(f"{c}_not_null", f"{c} IS NOT NULL") for c in cs]
_REST_SQL = {
    "idempotency_keys": ("fx_dom_keys", [
        *_NN("idempotency_key", "scope", "request_hash", "expires_at"),
        ("scope_not_blank", "length(trim(scope)) > 0"), ("key_not_blank", "length(trim(idempotency_key)) > 0"),
        ("expires_future", "expires_at > created_at")]),
    "journal_transactions": ("fx_dom_journal", [
        *_NN("transaction_ref", "idempotency_key_id", "status", "entry_type", "source_system"),
        ("status_domain", "status IN ('pending', 'posted', 'reversed', 'voided', 'failed')"),
        ("metadata_is_object", _JSON_OBJ.format(c="metadata")),
        ("entry_type_not_blank", "length(trim(entry_type)) > 0"),
        ("source_system_not_blank", "length(trim(source_system)) > 0"),
        ("distinct_reversal", "reversed_transaction_id IS NULL OR reversed_transaction_id <> id"),
        ("distinct_reversal_of", "reversal_of_transaction_id IS NULL OR reversal_of_transaction_id <> id")]),
    "balance_projections": ("fx_dom_projections", [
        *_NN("account_id", "currency_code", "balance_kind"),
        ("currency_code_check", "regexp_matches(currency_code, '^[A-Z]{3}$')"),
        ("balance_kind_domain", "balance_kind IN ('ledger', 'available', 'held')"),
        ("balances_nonnegative", "ledger_balance >= 0 AND available_balance >= 0 AND held_balance >= 0"),
        ("available_formula", "available_balance + held_balance = ledger_balance")]),
    "outbox_events": ("fx_dom_outbox", [
        *_NN("aggregate_type", "aggregate_id", "event_type", "status", "payload"),
        ("payload_is_object", _JSON_OBJ.format(c="payload")), ("headers_is_object", _JSON_OBJ.format(c="headers")),
        ("aggregate_not_blank", "length(trim(aggregate_type)) > 0"),
        ("event_type_not_blank", "length(trim(event_type)) > 0"), ("retry_count_nonnegative", "retry_count >= 0"),
        ("status_domain", "status IN ('pending', 'processing', 'published', 'failed', 'dead_letter')")]),
    "incoming_webhooks": ("fx_dom_webhooks", [
        *_NN("provider", "payload"), ("payload_is_object", _JSON_OBJ.format(c="payload")),
        ("headers_is_object", _JSON_OBJ.format(c="headers")), ("provider_not_blank", "length(trim(provider)) > 0")]),
    "audit_logs": ("fx_dom_audit", [
        *_NN("actor_type", "action", "entity_type"),
        ("action_domain", "action IN ('insert', 'update', 'delete', 'status_change', 'reconcile', 'reverse', 'void', 'adjust')"),
        ("metadata_is_object", _JSON_OBJ.format(c="metadata")), ("before_state_is_object", _OBJ("before_state")),
        ("after_state_is_object", _OBJ("after_state")), ("diff_is_object", _OBJ("diff")),
        ("actor_type_not_blank", "length(trim(actor_type)) > 0"),
        ("entity_type_not_blank", "length(trim(entity_type)) > 0")]),
    "reconciliation_batches": ("fx_dom_batches", [
        *_NN("source_system", "status"), ("source_not_blank", "length(trim(source_system)) > 0"),
        ("status_domain", "status IN ('pending', 'matched', 'mismatch', 'reviewed', 'resolved', 'closed')"),
        ("metadata_is_object", _JSON_OBJ.format(c="metadata")),
        ("amounts_nonnegative", "expected_total_amount >= 0 AND matched_total_amount >= 0 AND mismatch_total_amount >= 0"),
        ("counts_nonnegative", "expected_total_count >= 0 AND matched_total_count >= 0 AND mismatch_total_count >= 0")]),
    "reconciliation_items": ("fx_dom_items", [
        *_NN("reconciliation_batch_id", "currency_code", "amount", "status"),
        ("currency_code_check", "regexp_matches(currency_code, '^[A-Z]{3}$')"), ("amount_positive", "amount > 0"),
        ("matched_amount_nonnegative", "matched_amount >= 0"), ("variance_amount_nonnegative", "variance_amount >= 0"),
        ("status_domain", "status IN ('pending', 'matched', 'exception')"),
        ("metadata_is_object", _JSON_OBJ.format(c="metadata"))]),
}


def _rest_sql() -> str:
    parts = [f"SELECT '{rule}' AS rule, '{table}' AS table_name, id AS key, count(*) AS rows FROM {fx} "
             f"WHERE NOT COALESCE({ok}, true) GROUP BY id"
             for table, (fx, rules) in _REST_SQL.items() for rule, ok in rules]
    return "\nUNION ALL\n".join(parts)


@register("check_domains_rest", oracle=_rest_sql())
def q_check_domains_rest(spark, d):
    """C2 of the eight tables that check_domains_violations leaves out, through the catalogue pass."""
    x = Inputs(spark, d)
    bad, _ = K.check_ledger({t: conform(x.raw(fx), S.TABLES[t]) for t, (fx, _) in _REST_SQL.items()})
    return bad.filter(~F.col("rule").startswith("unique_") & ~F.col("rule").startswith("fk_"))
