"""Registered streaming queries (A2, I1-I9): each writes its input (derived from the test
tables) as files, runs the stream with ``availableNow`` over a file source
(several micro-batches), and returns the sink table. Oracles are the batch SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.plans.fixtures import NOW
from tallybook.plans.inputs import Inputs
from tallybook.plans import q_outbox, q_sources  # noqa: F401  (oracles reused below)
from tallybook.plans.registry import ORACLES, register
from tallybook.schemas import INCOMING_WEBHOOKS, conform
from tallybook.session import checkpoint_dir
from tallybook.sources.messages import parse_envelope
from tallybook.operators.posting import settlement_legs
from tallybook.streaming import jobs as J
from tallybook.streaming import posting as SP
from tallybook.streaming import stateful as S

_FILES = 4
_PARTS = 4


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/stream-{name}-{uuid.uuid4().hex}"


def _as_stream(spark: SparkSession, df: DataFrame, where: str, order: str,
               files: int = _FILES) -> DataFrame:
    """Write ``df`` as ``files`` time ranges of ``order`` (one append per range, so file
    modification times follow event time) and open them as a one-range-per-batch stream.

    Range bounds come from ``approxQuantile`` (a few numbers to the driver); each range is
    written by its own distributed job as ``_PARTS`` files, which make up one micro-batch.
    """
    u = F.unix_micros(F.col(order).cast("timestamp"))
    bounds = df.select(u.alias("_u")).approxQuantile(
        "_u", [i / files for i in range(1, files)], 0.001)
    edges = [None, *bounds, None]
    for lo, hi in zip(edges[:-1], edges[1:]):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (u >= F.lit(int(lo)))
        if hi is not None:
            cond = cond & (u < F.lit(int(hi)))
        df.filter(cond).repartition(_PARTS).write.mode("append").parquet(where)
    return J.read_requests(spark, fmt="parquet", path=where, schema=df.schema,
                           options={"maxFilesPerTrigger": _PARTS})


def _await(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


@register("stream_intake", oracle=ORACLES["webhooks_from_messages"])
def q_stream_intake(spark, d):
    x = Inputs(spark, d)
    base = _scratch(spark, "intake")
    msgs = _as_stream(spark, x.raw("fx_messages"), f"{base}/in", "timestamp")
    _await(J.stream_intake(msgs, f"{base}/out", f"{base}/rejects", f"{base}/ckpt"))
    rows = J.read_sink(spark, f"{base}/out")
    return rows.select("id", "provider", "external_event_id", "event_type", "headers", "status",
                       "created_at")


@register("stream_route", oracle=ORACLES["route_events"])
def q_stream_route(spark, d):
    x = Inputs(spark, d)
    base = _scratch(spark, "route")
    hooks = _as_stream(spark, conform(x.raw("fx_webhooks"), INCOMING_WEBHOOKS), f"{base}/in",
                       "created_at")
    _await(J.stream_route(hooks, f"{base}/out", f"{base}/ckpt"))
    return J.read_sink(spark, f"{base}/out").select("id", "handler")


@register("stream_dedupe", oracle="""
SELECT DISTINCT provider, external_event_id FROM fx_webhooks WHERE external_event_id IS NOT NULL
UNION ALL
SELECT provider, external_event_id FROM fx_webhooks WHERE external_event_id IS NULL
""")
def q_stream_dedupe(spark, d):
    x = Inputs(spark, d)
    base = _scratch(spark, "dedupe")
    hooks = _as_stream(spark, conform(x.raw("fx_webhooks"), INCOMING_WEBHOOKS), f"{base}/in",
                       "created_at")
    kept = J.stream_dedupe(hooks)
    _await(J.run(kept.writeStream.foreachBatch(J.batch_sink(f"{base}/out")), f"{base}/ckpt"))
    return J.read_sink(spark, f"{base}/out").select("provider", "external_event_id")


@register("stream_balances", oracle="""
WITH posted AS (SELECT id FROM fx_journal WHERE status = 'posted'),
per_side AS (
  SELECT account_id, currency_code, side, SUM(amount) AS moved, COUNT(*) AS n
  FROM fx_lines
  WHERE balance_kind IN ('ledger', 'available') AND journal_transaction_id IN (SELECT id FROM posted)
  GROUP BY account_id, currency_code, side)
SELECT account_id, per_side.currency_code,
       cast(sum(CASE WHEN side = ledger_normal_side THEN 1 ELSE -1 END * moved) AS decimal(38,8))
         AS ledger_balance, cast(sum(n) AS bigint) AS n_lines
FROM per_side, fx_accounts WHERE fx_accounts.id = account_id
GROUP BY account_id, per_side.currency_code
""")
def q_stream_balances(spark, d):
    x = Inputs(spark, d)
    base = _scratch(spark, "balances")
    posted = x.journal.filter(F.col("status") == "posted").select(
        F.col("id").alias("journal_transaction_id"))
    lines = x.lines.join(posted, "journal_transaction_id", "left_semi")
    stream = _as_stream(spark, lines, f"{base}/in", "created_at")
    agg = J.stream_balances(stream, x.accounts)
    _await(J.run(agg.writeStream.foreachBatch(J.batch_sink(f"{base}/out")), f"{base}/ckpt",
                 output_mode="update"))
    return J.latest_per_key(J.read_sink(spark, f"{base}/out"), ["account_id", "currency_code"])


@register("stream_settle", oracle="""
WITH c AS (SELECT hook_id, received_at, json_extract_string(body, '$.event') AS event,
                  json_extract_string(body, '$.data.reference') AS ref
           FROM fx_callbacks
           WHERE CASE WHEN json_valid(body) THEN json_type(body) = 'OBJECT' ELSE false END)
SELECT w.request_id AS w_id, c.hook_id, c.event, w.source_account_id, w.amount,
       w.requested_at, c.received_at
FROM fx_withdrawals w JOIN c ON c.ref = w.request_id
 AND c.received_at >= w.requested_at AND c.received_at <= w.requested_at + INTERVAL '24 hours'
""")
def q_stream_settle(spark, d):
    x = Inputs(spark, d)
    base = _scratch(spark, "settle")
    wd = _as_stream(spark, x.withdrawals, f"{base}/in_w", "requested_at")
    cb_raw = _as_stream(spark, x.raw("fx_callbacks").drop("src_event"), f"{base}/in_c",
                        "received_at")
    cb, _ = parse_envelope(cb_raw)
    joined = J.stream_settle(wd, cb)
    _await(J.run(joined.writeStream.foreachBatch(J.batch_sink(f"{base}/out")), f"{base}/ckpt"))
    return J.read_sink(spark, f"{base}/out").drop("batch_id")


#: An event far behind all others moves the final watermark past every timer.
_END = "2030-01-01 00:00:00"


def _with_end(df: DataFrame, **values: str) -> DataFrame:
    """``df`` with one more row of the given values (others null)."""
    end = df.sparkSession.range(1).select(*[
        F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return df.unionByName(end)


@register("stream_settle_unresolved", oracle="""
WITH c AS (SELECT received_at, CASE WHEN json_valid(body) THEN json_extract_string(body, '$.event') END AS event,
                  CASE WHEN json_valid(body) THEN json_extract_string(body, '$.data.reference') END AS ref
           FROM fx_late_callbacks)
SELECT request_id AS transfer_id, source_account_id, amount, requested_at + INTERVAL '24 hours' AS event_time
FROM fx_withdrawals w
WHERE NOT EXISTS (
  SELECT 1 FROM c WHERE c.ref = w.request_id AND c.received_at >= w.requested_at
    AND c.received_at < w.requested_at + INTERVAL '24 hours'
    AND (c.event IN ('transfer.failed', 'transfer.reversed')
         OR (c.event = 'transfer.success'
             AND w.currency_code IN (SELECT currency_code FROM fx_accounts WHERE account_type = 'settlement'))))
""")
def q_stream_settle_unresolved(spark, d):
    return (_settlement(spark, d).filter(F.col("outcome") == "expired")
            .select("transfer_id", "source_account_id", "amount", "event_time"))


@register("stream_settlement_balances", oracle="""
WITH c AS (SELECT hook_id, received_at, CASE WHEN json_valid(body) THEN json_extract_string(body, '$.event') END AS event,
                  CASE WHEN json_valid(body) THEN json_extract_string(body, '$.data.reference') END AS ref
           FROM fx_late_callbacks),
settle AS (SELECT currency_code, min(id) AS id FROM fx_accounts WHERE account_type = 'settlement' GROUP BY 1),
first AS (SELECT w.request_id, w.source_account_id, w.currency_code, w.amount, s.id AS settlement_id,
                 arg_min(c.event, c.received_at || c.hook_id) AS event
          FROM fx_withdrawals w JOIN c ON c.ref = w.request_id AND c.received_at >= w.requested_at
                                       AND c.received_at < w.requested_at + INTERVAL '24 hours'
          LEFT JOIN settle s ON s.currency_code = w.currency_code
          WHERE c.event IN ('transfer.failed', 'transfer.reversed') OR (c.event = 'transfer.success' AND s.id IS NOT NULL)
          GROUP BY ALL),
legs AS (SELECT source_account_id AS account_id, currency_code, 'debit' AS side, amount FROM first
         WHERE event = 'transfer.success'
         UNION ALL
         SELECT settlement_id, currency_code, 'credit', amount FROM first WHERE event = 'transfer.success')
SELECT l.account_id, l.currency_code, count(*) AS n_lines,
       cast(sum(CASE WHEN l.side = a.ledger_normal_side THEN l.amount ELSE -l.amount END) AS decimal(38,8))
         AS ledger_balance
FROM legs l JOIN fx_accounts a ON a.id = l.account_id GROUP BY 1, 2
""")
def q_stream_settlement_balances(spark, d):
    """What the settled withdrawals of the stream do to balances: F4's legs of every posted transfer."""
    x = Inputs(spark, d)
    posted = (_settlement(spark, d).filter(F.col("outcome") == "posted")
              .select(F.col("transfer_id").alias("id"), "source_account_id", "currency_code", "amount",
                      F.col("event_time").alias("requested_at")))
    legs = settlement_legs(posted, x.accounts)
    return J.stream_balances(legs, x.accounts)


def _settlement(spark: SparkSession, d: str) -> DataFrame:
    """Outcomes of the streamed settlement of all withdrawals."""
    x = Inputs(spark, d)
    base = _scratch(spark, "settlement")
    wd = _as_stream(spark, _with_end(x.withdrawals, request_id="~end", requested_at=_END), f"{base}/in_w",
                    "requested_at")
    late = _with_end(x.raw("fx_late_callbacks"), hook_id="~end", received_at=_END,
                     body='{"event":"end","data":{"reference":"~none"}}')
    cb, _ = parse_envelope(_as_stream(spark, late, f"{base}/in_c", "received_at"))
    out = S.stream_settlement(wd, cb, x.accounts)
    _await(J.run(out.writeStream.foreachBatch(J.batch_sink(f"{base}/out")), f"{base}/ckpt"))
    return J.read_sink(spark, f"{base}/out").drop("batch_id")


@register("stream_hold_timers", oracle="""
WITH h AS (SELECT hold_id, amount, expires_at, event_time FROM fx_hold_events WHERE action = 'create'),
m AS (SELECT e.hold_id, e.action, e.amount, e.event_time, h.amount AS held,
             row_number() OVER (PARTITION BY e.hold_id ORDER BY e.event_time, e.seq) AS rn
      FROM fx_hold_events e JOIN h ON h.hold_id = e.hold_id
      WHERE e.action <> 'create' AND e.event_time >= h.event_time AND e.amount > 0 AND e.amount <= h.amount
        AND (h.expires_at IS NULL OR e.event_time < h.expires_at))
SELECT hold_id, 'active' AS status, amount AS remaining_amount, cast(0 AS decimal(20,8)) AS captured_amount,
       cast(0 AS decimal(20,8)) AS released_amount, event_time FROM h
UNION ALL
SELECT hold_id, CASE action WHEN 'consume' THEN 'consumed' ELSE 'released' END,
       CASE action WHEN 'consume' THEN cast(0 AS decimal(20,8)) ELSE held - amount END,
       CASE action WHEN 'consume' THEN amount ELSE cast(0 AS decimal(20,8)) END,
       CASE action WHEN 'consume' THEN held - amount ELSE amount END, event_time
FROM m WHERE rn = 1
UNION ALL
SELECT hold_id, 'expired', cast(0 AS decimal(20,8)), cast(0 AS decimal(20,8)), amount, expires_at
FROM h WHERE expires_at IS NOT NULL AND hold_id NOT IN (SELECT hold_id FROM m)
""")
def q_stream_hold_timers(spark, d):
    x = Inputs(spark, d)
    base = _scratch(spark, "holds")
    events = _with_end(x.raw("fx_hold_events"), hold_id="~end", action="tick", event_time=_END)
    out = S.stream_hold_timers(_as_stream(spark, events, f"{base}/in", "event_time"))
    _await(J.run(out.writeStream.foreachBatch(J.batch_sink(f"{base}/out")), f"{base}/ckpt"))
    return J.read_sink(spark, f"{base}/out").drop("batch_id")


def _flaky(message: dict) -> tuple[str, str] | None:
    """A broker that times out by event number and attempt; every seventh event never gets through."""
    n = int(message["id"][2:])
    return ("BROKER_TIMEOUT", "publish timed out") if n % 7 == 0 or (n + message["retry_count"]) % 3 == 0 else None


@register("stream_outbox_retries", oracle="""
WITH RECURSIVE start AS (
  SELECT id, cast(substr(id, 3) AS bigint) AS n,
         CASE WHEN status = 'processing' THEN retry_count + 1 ELSE retry_count END AS retry,
         CASE WHEN status = 'processing' THEN updated_at + INTERVAL '5 minutes'
              ELSE greatest(updated_at, COALESCE(next_retry_at, updated_at)) END AS due
  FROM fx_outbox WHERE status IN ('pending', 'failed', 'processing')),
tries AS (
  SELECT id, n, 1 AS attempt, due, retry, n % 7 = 0 OR (n + retry) % 3 = 0 AS failed FROM start
  UNION ALL
  SELECT id, n, attempt + 1, due + cast(power(2, retry) AS bigint) * INTERVAL '1 second', retry + 1,
         n % 7 = 0 OR (n + retry + 1) % 3 = 0
  FROM tries WHERE failed AND retry <= 5)
SELECT id, attempt, due AS attempted_at,
       CASE WHEN NOT failed THEN 'published' WHEN retry > 5 THEN 'dead_letter' ELSE 'failed' END AS status,
       CASE WHEN failed AND retry <= 5 THEN retry + 1 ELSE retry END AS retry_count,
       CASE WHEN failed AND retry <= 5 THEN due + cast(power(2, retry) AS bigint) * INTERVAL '1 second' END
         AS next_retry_at,
       CASE WHEN failed THEN 'BROKER_TIMEOUT' END AS error_code
FROM tries
""")
def q_stream_outbox_retries(spark, d):
    from tallybook.schemas import OUTBOX_EVENTS
    x = Inputs(spark, d)
    base = _scratch(spark, "retries")
    rows = _with_end(conform(x.raw("fx_outbox"), OUTBOX_EVENTS), id="~end", status="published", updated_at=_END)
    out = S.stream_outbox_retries(_as_stream(spark, rows, f"{base}/in", "updated_at"), _flaky)
    _await(J.run(out.writeStream.foreachBatch(J.batch_sink(f"{base}/out")), f"{base}/ckpt"))
    return J.read_sink(spark, f"{base}/out").select("id", "attempt", "attempted_at", "status", "retry_count",
                                                    "next_retry_at", "error_code")


@register("stream_outbox", oracle="""
SELECT id, CASE WHEN status IN ('pending', 'failed') AND COALESCE(next_retry_at <= cast('""" + NOW + """'
                 AS timestamp), true) THEN 'published' ELSE status END AS status
FROM fx_outbox
""")
def q_stream_outbox(spark, d):
    from tallybook.schemas import OUTBOX_EVENTS
    x = Inputs(spark, d)
    base = _scratch(spark, "outbox")
    ob = _as_stream(spark, conform(x.raw("fx_outbox"), OUTBOX_EVENTS), f"{base}/in", "created_at")
    _await(J.stream_outbox(ob, f"{base}/topics", f"{base}/state", f"{base}/ckpt", now=NOW))
    return J.read_sink(spark, f"{base}/state").select("id", "status")


@register("stream_post")
def q_stream_post(spark, d):
    """Rows-only: outcome per request of the streamed posting step (one row per request)."""
    x = Inputs(spark, d)
    base = _scratch(spark, "post")
    from tallybook.schemas import IDEMPOTENCY_KEYS
    keys0 = conform(x.raw("fx_idem_keys"), IDEMPOTENCY_KEYS)
    reqs = _as_stream(spark, x.raw("fx_request_bodies"), f"{base}/in", "arrival", files=2)
    _await(SP.stream_post(spark, reqs, x.customers, x.accounts, keys0, x.projections,
                          f"{base}/out", f"{base}/ckpt", None))
    return SP.committed_rows(spark, f"{base}/out", "outcomes")


@register("backlog_windows", oracle="""
SELECT event_type AS channel, time_bucket(INTERVAL '6 hours', ts) AS window_start,
       time_bucket(INTERVAL '6 hours', ts) + INTERVAL '6 hours' AS window_end,
       count(*) AS arrivals, count(*) > 50 AS backlog
FROM events GROUP BY 1, 2
""")
def q_backlog_windows(spark, d):
    x = Inputs(spark, d)
    base = _scratch(spark, "backlog")
    ev = _as_stream(spark, x.table("events"), f"{base}/in", "ts")
    agg = J.backlog_windows(ev, event_time="ts", channel="event_type", size="6 hours")
    _await(J.run(agg.writeStream.foreachBatch(J.batch_sink(f"{base}/out")), f"{base}/ckpt",
                 output_mode="update"))
    return J.latest_per_key(J.read_sink(spark, f"{base}/out"), ["channel", "window_start"])
