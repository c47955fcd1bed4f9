"""Registered posting queries (F1-F4, F6-F8, F11, F16-F18) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook import schemas as S
from tallybook.operators import posting as P
from tallybook.plans.fixtures import NOW
from tallybook.plans.inputs import Inputs, conform
from tallybook.plans.registry import register

_LINE_COLS = """id, journal_transaction_id, line_number, account_id, side, amount, currency_code,
       balance_kind, memo, metadata, created_at"""


@register("transfer_legs", oracle=f"""
WITH legs AS (
  SELECT concat('transfer:', id) AS tx, 1 AS n, source_account_id AS account_id, 'debit' AS side,
         cast(amount + fee_amount AS decimal(20,8)) AS amount, currency_code, requested_at
  FROM fx_transfers
  UNION ALL
  SELECT concat('transfer:', id), 2, destination_account_id, 'credit', amount, currency_code,
         requested_at FROM fx_transfers
  UNION ALL
  SELECT concat('transfer:', t.id), 3, a.id, 'credit', t.fee_amount, t.currency_code, t.requested_at
  FROM fx_transfers t LEFT JOIN fx_accounts a
    ON a.account_type = 'fee' AND a.currency_code = t.currency_code
  WHERE t.fee_amount > 0)
SELECT concat(tx, '#', cast(n AS string)) AS id, tx AS journal_transaction_id, n AS line_number,
       account_id, side, amount, currency_code, 'available' AS balance_kind,
       cast(NULL AS string) AS memo, '{{}}' AS metadata, requested_at AS created_at
FROM legs
""".replace("{{}}", "{}"))
def q_transfer_legs(spark, d):
    x = Inputs(spark, d)
    return P.transfer_legs(x.transfers, x.accounts)


_DEP_TRF = """
SELECT d.request_id AS id, d.idempotency_key_id, d.customer_id,
       a.id AS source_account_id, d.destination_account_id, d.currency_code,
       d.amount, d.fee_amount, 'pending' AS status,
       CASE WHEN length(d.client_reference) > 0 THEN d.client_reference END AS client_reference,
       CASE WHEN length(d.external_reference) > 0 THEN d.external_reference END AS external_reference,
       d.metadata, d.requested_at, d.requested_at AS created_at, d.requested_at AS updated_at
FROM fx_deposits d LEFT JOIN fx_accounts a
  ON a.account_type = 'settlement' AND a.currency_code = d.currency_code
"""


@register("create_transfer_requests", oracle=_DEP_TRF)
def q_create_transfer_requests(spark, d):
    x = Inputs(spark, d)
    return P.create_transfer_requests(x.deposits, x.accounts, "deposit").select(
        "id", "idempotency_key_id", "customer_id", "source_account_id", "destination_account_id",
        "currency_code", "amount", "fee_amount", "status", "client_reference",
        "external_reference", "metadata", "requested_at", "created_at", "updated_at")


@register("deposit_legs", oracle=f"""
WITH t AS ({_DEP_TRF}),
legs AS (
  SELECT concat('deposit:', id) AS tx, 1 AS n, source_account_id AS account_id, 'debit' AS side,
         amount, currency_code, requested_at FROM t
  UNION ALL
  SELECT concat('deposit:', id), 2, destination_account_id, 'credit', amount, currency_code,
         requested_at FROM t)
SELECT concat(tx, '#', cast(n AS string)) AS id, tx AS journal_transaction_id, n AS line_number,
       account_id, side, amount, currency_code, 'available' AS balance_kind,
       cast(NULL AS string) AS memo, '{{}}' AS metadata, requested_at AS created_at
FROM legs
""".replace("{{}}", "{}"))
def q_deposit_legs(spark, d):
    x = Inputs(spark, d)
    return P.deposit_legs(P.create_transfer_requests(x.deposits, x.accounts, "deposit"), x.accounts)


_WD_TRF = """
SELECT w.request_id AS id, w.idempotency_key_id, w.customer_id, w.source_account_id,
       a.id AS destination_account_id, w.currency_code, w.amount, w.fee_amount,
       'pending' AS status, w.client_reference, w.external_reference, w.metadata,
       w.requested_at, w.requested_at AS created_at, w.requested_at AS updated_at
FROM fx_withdrawals w LEFT JOIN fx_accounts a
  ON a.account_type = 'settlement' AND a.currency_code = w.currency_code
"""


@register("hold_legs", oracle=f"""
WITH t AS ({_WD_TRF}),
legs AS (
  SELECT concat('hold:', id) AS tx, 1 AS n, source_account_id AS account_id, 'debit' AS side,
         amount, currency_code, requested_at, 'available' AS kind FROM t
  UNION ALL
  SELECT concat('hold:', id), 2, source_account_id, 'credit', amount, currency_code,
         requested_at, 'held' FROM t)
SELECT concat(tx, '#', cast(n AS string)) AS id, tx AS journal_transaction_id, n AS line_number,
       account_id, side, amount, currency_code, kind AS balance_kind,
       'funds reserved for withdrawal' AS memo, '{{}}' AS metadata, requested_at AS created_at
FROM legs
""".replace("{{}}", "{}"))
def q_hold_legs(spark, d):
    x = Inputs(spark, d)
    return P.hold_legs(P.create_transfer_requests(x.withdrawals, x.accounts, "withdrawal"))


@register("settlement_legs", oracle=f"""
WITH t AS ({_WD_TRF} WHERE a.id IS NOT NULL),
legs AS (
  SELECT concat('withdrawal:', id) AS tx, 1 AS n, source_account_id AS account_id,
         'debit' AS side, amount, currency_code, requested_at FROM t
  UNION ALL
  SELECT concat('withdrawal:', t.id), 2, a.id, 'credit', t.amount, t.currency_code, t.requested_at
  FROM t LEFT JOIN fx_accounts a ON a.account_type = 'settlement' AND a.currency_code = t.currency_code)
SELECT concat(tx, '#', cast(n AS string)) AS id, tx AS journal_transaction_id, n AS line_number,
       account_id, side, amount, currency_code, 'ledger' AS balance_kind,
       'withdrawal settled' AS memo, '{{}}' AS metadata, requested_at AS created_at
FROM legs
""".replace("{{}}", "{}"))
def q_settlement_legs(spark, d):
    x = Inputs(spark, d)
    return P.settlement_legs(P.create_transfer_requests(x.withdrawals, x.accounts, "withdrawal"),
                             x.accounts)


@register("create_journal", oracle=f"""
WITH t AS ({_WD_TRF})
SELECT concat('hold:', id) AS id, concat('ref:hold:', id) AS transaction_ref,
       id AS transfer_request_id, idempotency_key_id, 'pending' AS status, 'hold' AS entry_type,
       cast(requested_at AS date) AS accounting_date, requested_at AS effective_at,
       cast(NULL AS timestamp) AS posted_at, 'core' AS source_system, id AS source_event_id,
       metadata, requested_at AS created_at
FROM t
""")
def q_create_journal(spark, d):
    x = Inputs(spark, d)
    trf = P.create_transfer_requests(x.withdrawals, x.accounts, "withdrawal")
    return P.create_journal(trf, "hold")


@register("post_transactions", oracle=f"""
SELECT j.id, j.transaction_ref, j.status AS old_status,
       CASE WHEN p.id IS NOT NULL AND j.status <> 'posted' THEN 'posted' ELSE j.status END AS status,
       CASE WHEN p.id IS NOT NULL AND j.status <> 'posted' THEN cast('{NOW}' AS timestamp)
            ELSE j.posted_at END AS posted_at
FROM fx_journal j LEFT JOIN (SELECT DISTINCT id FROM fx_post_ids) p ON p.id = j.id
""")
def q_post_transactions(spark, d):
    x = Inputs(spark, d)
    out = P.post_transactions(x.journal.withColumn("old_status", F.col("status")),
                              x.raw("fx_post_ids"), NOW)
    return out.select("id", "transaction_ref", "old_status", "status", "posted_at")


@register("update_transfer_status", oracle=f"""
SELECT t.id, COALESCE(c.status, t.status) AS status,
       CASE WHEN c.status = 'posted' THEN cast('{NOW}' AS timestamp) ELSE t.posted_at END AS posted_at,
       CASE WHEN c.status = 'failed' THEN cast('{NOW}' AS timestamp) ELSE t.failed_at END AS failed_at,
       CASE WHEN c.id IS NOT NULL THEN cast('{NOW}' AS timestamp) ELSE t.updated_at END AS updated_at
FROM fx_transfers t LEFT JOIN fx_status_changes c ON c.id = t.id
""")
def q_update_transfer_status(spark, d):
    x = Inputs(spark, d)
    out = P.update_transfer_status(x.transfers, x.raw("fx_status_changes"), NOW)
    return out.select("id", "status", "posted_at", "failed_at", "updated_at")


@register("update_transfer_external_ref", oracle="""
SELECT t.id, COALESCE(c.external_reference, t.external_reference) AS external_reference
FROM fx_transfers t LEFT JOIN fx_status_changes c ON c.id = t.id
""")
def q_update_transfer_external_ref(spark, d):
    x = Inputs(spark, d)
    out = P.update_transfer_external_ref(x.transfers, x.raw("fx_status_changes"), NOW)
    return out.select("id", "external_reference")


@register("update_account_status", oracle=f"""
SELECT a.id, COALESCE(c.status, a.status) AS status,
       CASE WHEN c.status = 'closed' THEN cast('{NOW}' AS timestamp) ELSE a.closed_at END AS closed_at
FROM fx_accounts a LEFT JOIN (
  SELECT concat('C', cast(c_custkey AS string)) AS id,
         CASE WHEN c_custkey % 2 = 0 THEN 'closed' ELSE 'frozen' END AS status
  FROM customer WHERE c_custkey % 13 = 0) c ON c.id = a.id
""")
def q_update_account_status(spark, d):
    x = Inputs(spark, d)
    changes = x.table("customer").filter(F.col("c_custkey") % 13 == 0).select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id"),
        F.when(F.col("c_custkey") % 2 == 0, "closed").otherwise("frozen").alias("status"))
    return P.update_account_status(x.accounts, changes, NOW).select("id", "status", "closed_at")


@register("update_customer_status", oracle="""
SELECT u.id, COALESCE(c.status, u.status) AS status
FROM fx_customers u LEFT JOIN (
  SELECT concat('U', cast(c_custkey AS string)) AS id, 'suspended' AS status
  FROM customer WHERE c_custkey % 17 = 0) c ON c.id = u.id
""")
def q_update_customer_status(spark, d):
    x = Inputs(spark, d)
    changes = x.table("customer").filter(F.col("c_custkey") % 17 == 0).select(
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("id"),
        F.lit("suspended").alias("status"))
    return P.update_customer_status(x.customers, changes, NOW).select("id", "status")


_DELTAS = """
WITH o AS (
  SELECT o.*, s.id AS st, f.id AS fa FROM fx_ops o
  LEFT JOIN fx_accounts s ON s.account_type = 'settlement' AND s.currency_code = o.currency_code
  LEFT JOIN fx_accounts f ON f.account_type = 'fee' AND f.currency_code = o.currency_code
  WHERE NOT (op_type IN ('deposit', 'settle_success') AND s.id IS NULL)
    AND NOT (op_type = 'transfer' AND fee_amount > 0 AND f.id IS NULL)),
e AS (
  SELECT op_id, currency_code, st AS account_id, 'debit' AS side, amount, 1 AS l, 0 AS h, 1 AS v FROM o WHERE op_type = 'deposit'
  UNION ALL SELECT op_id, currency_code, destination_account_id, 'credit', amount, 1, 0, 1 FROM o WHERE op_type = 'deposit'
  UNION ALL SELECT op_id, currency_code, source_account_id, 'debit', amount + fee_amount, 1, 0, 1 FROM o WHERE op_type = 'transfer'
  UNION ALL SELECT op_id, currency_code, destination_account_id, 'credit', amount, 1, 0, 1 FROM o WHERE op_type = 'transfer'
  UNION ALL SELECT op_id, currency_code, fa, 'credit', fee_amount, 1, 0, 1 FROM o WHERE op_type = 'transfer'
  UNION ALL SELECT op_id, currency_code, source_account_id, 'none', amount, 0, 1, -1 FROM o WHERE op_type = 'hold'
  UNION ALL SELECT op_id, currency_code, source_account_id, 'debit', amount, 1, 0, 0 FROM o WHERE op_type = 'settle_success'
  UNION ALL SELECT op_id, currency_code, source_account_id, 'none', amount, 0, -1, 0 FROM o WHERE op_type = 'settle_success'
  UNION ALL SELECT op_id, currency_code, st, 'credit', amount, 1, 0, 1 FROM o WHERE op_type = 'settle_success'
  UNION ALL SELECT op_id, currency_code, source_account_id, 'none', amount, 0, -1, 1 FROM o WHERE op_type = 'settle_failed'),
s AS (
  SELECT e.*, CASE WHEN e.side = 'none' THEN e.amount WHEN e.side = COALESCE(a.ledger_normal_side, 'credit') THEN e.amount
                   ELSE -e.amount END AS sa
  FROM e LEFT JOIN fx_accounts a ON a.id = e.account_id WHERE e.amount > 0)
SELECT op_id, account_id, currency_code,
       cast(SUM(sa * l) AS decimal(20,8)) AS d_ledger,
       cast(SUM(sa * h) AS decimal(20,8)) AS d_held,
       cast(SUM(sa * v) AS decimal(20,8)) AS d_available
FROM s GROUP BY op_id, account_id, currency_code
"""


@register("balance_deltas", oracle=_DELTAS)
def q_balance_deltas(spark, d):
    x = Inputs(spark, d)
    return P.balance_deltas(x.ops, x.accounts)


@register("apply_deltas", oracle=f"""
WITH dl AS ({_DELTAS}),
agg AS (SELECT account_id, currency_code, SUM(d_ledger) AS dl, SUM(d_held) AS dh,
               SUM(d_available) AS dv FROM dl GROUP BY account_id, currency_code),
p AS (SELECT * FROM fx_projections WHERE balance_kind = 'available')
SELECT COALESCE(p.account_id, agg.account_id) AS account_id,
       COALESCE(p.currency_code, agg.currency_code) AS currency_code,
       'available' AS balance_kind,
       cast(COALESCE(p.ledger_balance, 0) + COALESCE(agg.dl, 0) AS decimal(20,8)) AS ledger_balance,
       cast(COALESCE(p.available_balance, 0) + COALESCE(agg.dv, 0) AS decimal(20,8)) AS available_balance,
       cast(COALESCE(p.held_balance, 0) + COALESCE(agg.dh, 0) AS decimal(20,8)) AS held_balance,
       COALESCE(p.version, 0) + CASE WHEN agg.dl IS NOT NULL THEN 1 ELSE 0 END AS version,
       CASE WHEN agg.dl IS NOT NULL THEN cast('{NOW}' AS timestamp) ELSE p.computed_at END AS computed_at
FROM p FULL OUTER JOIN agg ON p.account_id = agg.account_id AND p.currency_code = agg.currency_code
UNION ALL
SELECT account_id, currency_code, balance_kind, ledger_balance, available_balance, held_balance, version,
       computed_at
FROM fx_projections WHERE balance_kind <> 'available'
""")
def q_apply_deltas(spark, d):
    x = Inputs(spark, d)
    out = P.apply_deltas(x.projections, P.balance_deltas(x.ops, x.accounts), NOW)
    return out.drop("last_transaction_id", "last_line_id")


@register("projection_after_ops", oracle=f"""
WITH dl AS ({_DELTAS}),
agg AS (SELECT account_id, currency_code, SUM(d_ledger) AS dl, SUM(d_held) AS dh,
               SUM(d_available) AS dv FROM dl GROUP BY account_id, currency_code),
sys AS (SELECT currency_code, min(id) FILTER (WHERE account_type = 'settlement') AS st,
               min(id) FILTER (WHERE account_type = 'fee') AS fa FROM fx_accounts GROUP BY currency_code),
o AS (SELECT f.*, st, fa FROM fx_ops f LEFT JOIN sys USING (currency_code)
      WHERE NOT (op_type IN ('deposit', 'settle_success') AND st IS NULL)
        AND NOT (op_type = 'transfer' AND fee_amount > 0 AND fa IS NULL)),
n AS (SELECT *, unnest(CASE op_type WHEN 'transfer' THEN CASE WHEN fee_amount > 0 THEN [1, 2, 3] ELSE [1, 2] END
                       WHEN 'hold' THEN [1] WHEN 'settle_failed' THEN [] ELSE [1, 2] END) AS k FROM o),
leg AS (SELECT op_ts, seq_key, op_id, currency_code, k,
               CASE WHEN op_type = 'deposit' AND k = 1 THEN st WHEN op_type = 'settle_success' AND k = 2 THEN st
                    WHEN k = 1 THEN source_account_id WHEN k = 2 THEN destination_account_id ELSE fa END AS account_id,
               CASE op_type WHEN 'settle_success' THEN concat('withdrawal:', hold_op_id)
                    ELSE concat(op_type, ':', op_id) END AS tx FROM n),
pick AS (SELECT account_id, currency_code, tx, concat(tx, '#', cast(k AS string)) AS line,
                row_number() OVER (PARTITION BY account_id, currency_code
                                   ORDER BY op_ts DESC, seq_key DESC, op_id DESC, k) AS rn FROM leg),
p AS (SELECT * FROM fx_projections WHERE balance_kind = 'available')
SELECT COALESCE(p.account_id, agg.account_id) AS account_id,
       COALESCE(p.currency_code, agg.currency_code) AS currency_code,
       cast(COALESCE(p.ledger_balance, 0) + COALESCE(agg.dl, 0) AS decimal(20,8)) AS ledger_balance,
       cast(COALESCE(p.held_balance, 0) + COALESCE(agg.dh, 0) AS decimal(20,8)) AS held_balance,
       COALESCE(p.version, 0) + CASE WHEN agg.dl IS NOT NULL THEN 1 ELSE 0 END AS version,
       pick.tx AS last_transaction_id, pick.line AS last_line_id
FROM p FULL OUTER JOIN agg ON p.account_id = agg.account_id AND p.currency_code = agg.currency_code
LEFT JOIN pick ON pick.rn = 1 AND pick.account_id = COALESCE(p.account_id, agg.account_id)
  AND pick.currency_code = COALESCE(p.currency_code, agg.currency_code)
""")
def q_projection_after_ops(spark, d):
    x = Inputs(spark, d)
    out = P.apply_deltas(x.projections, P.balance_deltas(x.ops, x.accounts), NOW,
                         lasts=P.last_entries_of_ops(x.ops, x.accounts))
    return out.filter(F.col("balance_kind") == "available").select(
        "account_id", "currency_code", "ledger_balance", "held_balance", "version", "last_transaction_id", "last_line_id")


@register("outbox_from_transfers", oracle="""
SELECT concat(CASE status WHEN 'posted' THEN 'transfer.posted' ELSE 'transfer.failed' END, ':', id) AS id,
       'transfer_request' AS aggregate_type, id AS aggregate_id,
       CASE status WHEN 'posted' THEN 'transfer.posted' ELSE 'transfer.failed' END AS event_type,
       'pending' AS status, idempotency_key_id,
       concat('{"transfer_id":"', id, '","status":"', status, '","source_account_id":"',
              source_account_id, '","destination_account_id":"', destination_account_id,
              '","amount":"', cast(amount AS string), '","fee_amount":"',
              cast(fee_amount AS string), '","currency_code":"', currency_code, '"}') AS payload,
       concat('{"client_reference":"', COALESCE(client_reference, ''), '","content_type":"application/json",'
              || '"event_transaction":"ref:transfer:', id, '","source_system":"core"}') AS headers,
       destination_account_id AS partition_key, 0 AS retry_count,
       updated_at AS created_at, updated_at
FROM fx_transfers WHERE status IN ('posted', 'failed')
""")
def q_outbox_from_transfers(spark, d):
    return P.outbox_from_transfers(Inputs(spark, d).transfers)


@register("link_reversals", oracle="""
WITH rev AS (SELECT id AS reversal_id, reversal_of_transaction_id AS original_id
             FROM fx_reversal_journal),
lines AS (SELECT journal_transaction_id, account_id, currency_code, balance_kind, side, amount
          FROM fx_lines UNION ALL
          SELECT journal_transaction_id, account_id, currency_code, balance_kind, side, amount
          FROM fx_reversal_lines),
per AS (SELECT journal_transaction_id, account_id, currency_code, balance_kind,
               SUM(CASE WHEN side = 'debit' THEN amount ELSE 0 END) AS dr,
               SUM(CASE WHEN side = 'credit' THEN amount ELSE 0 END) AS cr
        FROM lines GROUP BY 1, 2, 3, 4),
o AS (SELECT rev.reversal_id, per.* FROM per JOIN rev ON per.journal_transaction_id = rev.original_id),
r AS (SELECT rev.reversal_id, per.* FROM per JOIN rev ON per.journal_transaction_id = rev.reversal_id),
j AS (SELECT COALESCE(o.reversal_id, r.reversal_id) AS reversal_id,
             COALESCE(o.dr, 0) = COALESCE(r.cr, 0) AND COALESCE(o.cr, 0) = COALESCE(r.dr, 0) AS ok
      FROM o FULL OUTER JOIN r ON o.reversal_id = r.reversal_id AND o.account_id = r.account_id
       AND o.currency_code = r.currency_code AND o.balance_kind = r.balance_kind),
g AS (SELECT reversal_id, bool_and(ok) AS mirrored, count(*) AS n_keys FROM j GROUP BY reversal_id)
SELECT rev.reversal_id, rev.original_id, COALESCE(g.mirrored, false) AS mirrored,
       COALESCE(g.n_keys, 0) AS n_keys
FROM rev LEFT JOIN g ON g.reversal_id = rev.reversal_id
""")
def q_link_reversals(spark, d):
    x = Inputs(spark, d)
    txs = x.journal.unionByName(conform(x.raw("fx_reversal_journal"), S.JOURNAL_TRANSACTIONS))
    lines = x.lines.unionByName(conform(x.raw("fx_reversal_lines"), S.JOURNAL_LINES))
    return P.link_reversals(txs, lines)
