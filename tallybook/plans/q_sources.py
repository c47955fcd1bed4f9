"""Registered source/sink queries (A1, A3-A8) with their DuckDB oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallybook import schemas as S
from tallybook.operators import balances as B
from tallybook.operators import outbox as O
from tallybook.plans.fixtures import NOW
from tallybook.plans.inputs import Inputs, conform
from tallybook.plans.q_balances import _LEDGER
from tallybook.plans.registry import register
from tallybook.session import checkpoint_dir
from tallybook.sources import ledger_io as IO
from tallybook.sources import messages as M
from tallybook.sources import snapshots as SN

_PARSED = """
SELECT request_id, kind, json_extract_string(body, '$.customer_id') AS customer_id,
       json_extract_string(body, '$.idempotency_key_id') AS idempotency_key_id,
       TRY_CAST(trim(json_extract_string(body, '$.amount')) AS decimal(20,8)) AS amount,
       TRY_CAST(trim(json_extract_string(body, '$.fee_amount')) AS decimal(20,8)) AS fee_amount,
       json_extract_string(body, '$.amount') AS amount_text,
       json_extract_string(body, '$.fee_amount') AS fee_text,
       CASE WHEN json_valid(body) THEN json_type(body) = 'OBJECT' ELSE false END AS ok_json
FROM fx_request_bodies
"""

_REASON = """CASE WHEN NOT ok_json THEN 'invalid json'
     WHEN COALESCE(trim(amount_text), '') <> '' AND amount IS NULL THEN 'invalid amount'
     WHEN COALESCE(trim(fee_text), '') <> '' AND fee_amount IS NULL THEN 'invalid fee amount' END"""


@register("parse_requests", oracle=f"""
WITH p AS ({_PARSED})
SELECT request_id, kind, customer_id, idempotency_key_id, amount, fee_amount FROM p
WHERE {_REASON} IS NULL
""")
def q_parse_requests(spark, d):
    good, _ = M.parse_requests(Inputs(spark, d).raw("fx_request_bodies"))
    return good.select("request_id", "kind", "customer_id", "idempotency_key_id", "amount",
                       "fee_amount")


@register("parse_requests_rejects", oracle=f"""
WITH p AS ({_PARSED})
SELECT request_id, {_REASON} AS reason FROM p WHERE {_REASON} IS NOT NULL
""")
def q_parse_requests_rejects(spark, d):
    _, bad = M.parse_requests(Inputs(spark, d).raw("fx_request_bodies"))
    return bad.select("request_id", "reason")


_OK_BODY = "CASE WHEN json_valid(body) THEN json_type(body) = 'OBJECT' ELSE false END"


@register("parse_envelope", oracle=f"""
SELECT hook_id, json_extract_string(body, '$.event') AS event,
       json_extract_string(body, '$.id') AS event_id,
       json_extract_string(body, '$.data.reference') AS reference,
       json_extract_string(body, '$.data.status') AS status,
       TRY_CAST(json_extract_string(body, '$.data.Amount') AS decimal(20,8)) AS amount
FROM fx_callbacks WHERE {_OK_BODY}
""")
def q_parse_envelope(spark, d):
    good, _ = M.parse_envelope(Inputs(spark, d).raw("fx_callbacks"))
    return good.select("hook_id", "event", "event_id", F.col("data.reference").alias("reference"),
                       F.col("data.status").alias("status"),
                       F.col("data.Amount").try_cast(S.MONEY).alias("amount"))


@register("parse_envelope_rejects", oracle=f"""
SELECT hook_id, 'invalid json' AS reason FROM fx_callbacks WHERE NOT {_OK_BODY}
""")
def q_parse_envelope_rejects(spark, d):
    _, bad = M.parse_envelope(Inputs(spark, d).raw("fx_callbacks"))
    return bad.select("hook_id", "reason")


@register("webhooks_from_messages", oracle="""
WITH m AS (
  SELECT *, CASE WHEN topic = 'withdrawal.webhook' THEN json_extract_string(value, '$.id')
                 WHEN topic = 'deposit.transfer'
                 THEN json_extract_string(value, '$.external_reference') END AS ext
  FROM fx_messages
  WHERE CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE false END)
SELECT message_id AS id, json_extract_string(value, '$.provider') AS provider,
       ext AS external_event_id, topic AS event_type,
       CASE WHEN ext IS NULL THEN '{}' ELSE concat('{"X-Paystack-Request-Id":"', ext, '"}') END
           AS headers,
       'pending' AS status, timestamp AS created_at
FROM m
""")
def q_webhooks_from_messages(spark, d):
    rows, _ = M.webhooks_from_messages(Inputs(spark, d).raw("fx_messages"))
    return rows.select("id", "provider", "external_event_id", "event_type", "headers", "status",
                       "created_at")


def _told(c: str) -> str:
    """An instant as the message carries it, left out where there is none."""
    return f"""CASE WHEN {c} IS NULL THEN '' ELSE concat(',"{c}":"', strftime({c}, '%Y-%m-%dT%H:%M:%S.%g'), '"') END"""


def _quoted(c: str) -> str:
    return f"""replace(replace({c}, '\\', '\\\\'), '"', '\\"')"""


@register("outbox_messages", oracle=f"""
SELECT event_type AS topic, partition_key AS key, id,
       concat('{{"id":"', id, '","aggregate_type":"', aggregate_type, '","aggregate_id":"', aggregate_id, '","event_type":"', event_type,
              '","status":"', status, '","payload":"', {_quoted('payload')}, '","headers":"', {_quoted('headers')},
              '","partition_key":"', partition_key, '","retry_count":', cast(retry_count AS string), {_told('next_retry_at')},
              {_told('created_at')}, {_told('updated_at')}, '}}') AS value
FROM fx_outbox
WHERE status IN ('pending', 'failed') AND COALESCE(next_retry_at <= cast('{NOW}' AS timestamp), true)
""")
def q_outbox_messages(spark, d):
    x = Inputs(spark, d)
    msgs = M.outbox_messages(conform(x.raw("fx_outbox"), S.OUTBOX_EVENTS)
                             .filter(O.is_due(NOW)))
    return msgs.select("topic", "key", F.get_json_object("value", "$.id").alias("id"), "value")


@register("journal_roundtrip_balance", oracle=_LEDGER)
def q_journal_roundtrip_balance(spark, d):
    """A6 then A1: append the journal to parquet, read it back with the declared schemas,
    and compute E1 on what was read."""
    x = Inputs(spark, d)
    where = f"{checkpoint_dir(spark)}/journal-{uuid.uuid4().hex}"
    IO.append_journal(x.journal, x.lines, where)
    t = IO.load_ledger(spark, where, ["journal_transactions", "journal_lines"])
    return B.ledger_balance(t["journal_lines"], t["journal_transactions"], x.accounts)


@register("audit_from_snapshots", oracle="""
SELECT COALESCE(b.id, a.id) AS entity_id,
       CASE WHEN b.id IS NULL THEN 'insert' WHEN a.id IS NULL THEN 'delete' ELSE 'update' END
           AS action,
       CASE WHEN b.id IS NULL OR a.id IS NULL THEN '' ELSE 'amount' END AS changed_columns
FROM fx_lines b FULL OUTER JOIN fx_lines_after a ON a.id = b.id
WHERE a.id IS NULL OR b.id IS NULL OR a.amount <> b.amount
""")
def q_audit_from_snapshots(spark, d):
    x = Inputs(spark, d)
    after = conform(x.raw("fx_lines_after"), S.JOURNAL_LINES)
    audit = IO.audit_from_snapshots(x.lines, after, "id", "journal_lines")
    return audit.select("entity_id", "action", "changed_columns")


@register("journal_append_twice", oracle=_LEDGER)
def q_journal_append_twice(spark, d):
    """A6 when it fails: a batch written twice, another whose marker is missing; readers see each line once."""
    x = Inputs(spark, d)
    where = f"{checkpoint_dir(spark)}/journal-{uuid.uuid4().hex}"
    even = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    for batch, part in (("a", x.journal.filter(even)), ("b", x.journal.filter(~even)), ("a", x.journal.filter(even))):
        own = part.select(F.col("id").alias("journal_transaction_id"))
        IO.append_journal(part, x.lines.join(own, "journal_transaction_id", "left_semi"), where, batch=batch)
    (x.lines.withColumn("accounting_period", F.lit("2024-01-01").cast("date")).write.partitionBy("accounting_period")
     .parquet(f"{where}/journal_lines/batch=unfinished"))
    t = IO.load_ledger(spark, where, ["journal_transactions", "journal_lines"])
    return B.ledger_balance(t["journal_lines"], t["journal_transactions"], x.accounts)


@register("colocated_ledger_balance", oracle=_LEDGER)
def q_colocated_ledger_balance(spark, d):
    """A6 into tables bucketed by transaction, each batch appended twice, then E1 on them."""
    x = Inputs(spark, d)
    name = f"journal_{uuid.uuid4().hex}"
    IO.create_journal_tables(spark, name, f"{checkpoint_dir(spark)}/{name}", buckets=8)
    even = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    for batch, part in (("a", x.journal.filter(even)), ("b", x.journal.filter(~even)), ("b", x.journal.filter(~even))):
        own = part.select(F.col("id").alias("journal_transaction_id"))
        IO.append_to_journal_tables(part, x.lines.join(own, "journal_transaction_id", "left_semi"), name, batch)
    headers, lines = IO.journal_tables(spark, name)
    return B.ledger_balance(lines, headers, x.accounts)


def _snapshots(spark, d):
    x = Inputs(spark, d)
    base = f"{checkpoint_dir(spark)}/snapshots-{uuid.uuid4().hex}"
    SN.write_snapshot(x.lines, f"{base}/before", buckets=64)
    SN.write_snapshot(conform(x.raw("fx_lines_after"), S.JOURNAL_LINES), f"{base}/after", buckets=64)
    return f"{base}/before", f"{base}/after"


#: A journal line as the audit trail writes it (null columns left out).
_LINE_JSON = """concat('{"id":"', X.id, '","journal_transaction_id":"', X.journal_transaction_id, '","line_number":',
  cast(X.line_number AS string), ',"account_id":"', X.account_id, '","side":"', X.side, '","amount":', cast(X.amount AS string),
  ',"currency_code":"', X.currency_code, '","balance_kind":"', X.balance_kind, '","metadata":"', X.metadata,
  '","created_at":"', strftime(X.created_at, '%Y-%m-%dT%H:%M:%S.%g'), '"}')"""


@register("audit_between_snapshots", oracle=f"""
SELECT COALESCE(b.id, a.id) AS entity_id, 'journal_lines' AS entity_type,
       CASE WHEN b.id IS NULL THEN 'insert' WHEN a.id IS NULL THEN 'delete' ELSE 'update' END AS action,
       CASE WHEN b.id IS NOT NULL THEN {_LINE_JSON.replace('X.', 'b.')} END AS before_state,
       CASE WHEN a.id IS NOT NULL THEN {_LINE_JSON.replace('X.', 'a.')} END AS after_state,
       CASE WHEN b.id IS NOT NULL AND a.id IS NOT NULL
            THEN concat('{{"amount":{{"before":"', cast(b.amount AS string), '","after":"', cast(a.amount AS string), '"}}}}') END AS diff,
       'nightly-7' AS request_id, 'run-2024-02-01' AS correlation_id
FROM fx_lines b FULL OUTER JOIN fx_lines_after a ON a.id = b.id
WHERE a.id IS NULL OR b.id IS NULL OR a.amount <> b.amount
""")
def q_audit_between_snapshots(spark, d):
    before, after = _snapshots(spark, d)
    audit = SN.audit_between(spark, before, after, "journal_lines", request_id="nightly-7",
                             correlation_id="run-2024-02-01")
    return audit.select("entity_id", "entity_type", "action", "before_state", "after_state", "diff", "request_id",
                        "correlation_id")


@register("append_only_between_snapshots", oracle="""
SELECT CASE WHEN a.id IS NULL THEN 'deleted' ELSE 'updated' END AS rule, 'journal_lines' AS table_name, b.id AS key
FROM fx_lines b LEFT JOIN fx_lines_after a ON a.id = b.id WHERE a.id IS NULL OR a.amount <> b.amount
""")
def q_append_only_between_snapshots(spark, d):
    return SN.append_only_violations(spark, *_snapshots(spark, d)).select("rule", "table_name", "key")
