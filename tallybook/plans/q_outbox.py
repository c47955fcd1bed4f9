"""Registered outbox and webhook lifecycle queries (H1-H9) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.operators import outbox as O
from tallybook.plans.inputs import Inputs
from tallybook.plans.registry import register
from tallybook.schemas import INCOMING_WEBHOOKS, OUTBOX_EVENTS, conform

_NOW = "2024-01-20 00:00:00"


def _outbox(x: Inputs):
    return conform(x.raw("fx_outbox"), OUTBOX_EVENTS)


def _hooks(x: Inputs):
    return conform(x.raw("fx_webhooks"), INCOMING_WEBHOOKS)


@register("claim_events", oracle=f"""
SELECT id, 'processing' AS status, cast('{_NOW}' AS timestamp) AS updated_at FROM fx_outbox
WHERE status IN ('pending', 'failed')
  AND (next_retry_at IS NULL OR next_retry_at <= cast('{_NOW}' AS timestamp))
ORDER BY created_at, id LIMIT 100
""")
def q_claim_events(spark, d):
    _, claimed = O.claim_events(_outbox(Inputs(spark, d)), _NOW)
    return claimed.select("id", "status", "updated_at")


@register("mark_published", oracle=f"""
SELECT o.id, CASE WHEN r.id IS NOT NULL THEN 'published' ELSE o.status END AS status,
       CASE WHEN r.id IS NOT NULL THEN cast('{_NOW}' AS timestamp) END AS published_at
FROM fx_outbox o LEFT JOIN (SELECT DISTINCT id FROM fx_delivery WHERE delivered) r ON r.id = o.id
""")
def q_mark_published(spark, d):
    x = Inputs(spark, d)
    return O.mark_published(_outbox(x), x.raw("fx_delivery"), _NOW).select(
        "id", "status", "published_at")


@register("mark_failed", oracle=f"""
SELECT o.id,
       CASE WHEN r.id IS NULL THEN o.status WHEN o.retry_count > 5 THEN 'dead_letter'
            ELSE 'failed' END AS status,
       CASE WHEN r.id IS NULL OR o.retry_count > 5 THEN o.retry_count ELSE o.retry_count + 1 END
           AS retry_count,
       CASE WHEN r.id IS NULL OR o.retry_count > 5 THEN o.next_retry_at
            ELSE cast('{_NOW}' AS timestamp)
                 + cast(power(2, o.retry_count) AS bigint) * INTERVAL '1 second' END
           AS next_retry_at,
       CASE WHEN r.id IS NULL THEN NULL ELSE r.error_code END AS error_code
FROM fx_outbox o LEFT JOIN (SELECT * FROM fx_delivery WHERE NOT delivered) r ON r.id = o.id
""")
def q_mark_failed(spark, d):
    x = Inputs(spark, d)
    return O.mark_failed(_outbox(x), x.raw("fx_delivery"), _NOW).select(
        "id", "status", "retry_count", "next_retry_at", "error_code")


@register("dead_letter", oracle="""
SELECT o.id, 'dead_letter' AS status FROM fx_outbox o
WHERE o.retry_count > 5 AND o.id IN (SELECT id FROM fx_delivery WHERE NOT delivered)
""")
def q_dead_letter(spark, d):
    x = Inputs(spark, d)
    return O.dead_letter(_outbox(x), x.raw("fx_delivery")).select("id", "status")


@register("reset_stuck", oracle=f"""
SELECT id,
       CASE WHEN status = 'processing'
             AND updated_at < cast('{_NOW}' AS timestamp) - INTERVAL '5 minutes'
            THEN 'pending' ELSE status END AS status,
       CASE WHEN status = 'processing'
             AND updated_at < cast('{_NOW}' AS timestamp) - INTERVAL '5 minutes'
            THEN retry_count + 1 ELSE retry_count END AS retry_count
FROM fx_outbox
""")
def q_reset_stuck(spark, d):
    return O.reset_stuck(_outbox(Inputs(spark, d)), _NOW).select("id", "status", "retry_count")


@register("claim_webhooks", oracle="""
SELECT id, provider, created_at FROM fx_webhooks WHERE status = 'pending'
ORDER BY created_at, id LIMIT 100
""")
def q_claim_webhooks(spark, d):
    return O.claim_webhooks(_hooks(Inputs(spark, d))).select("id", "provider", "created_at")


_OK = "CASE WHEN json_valid(payload) THEN json_type(payload) = 'OBJECT' ELSE false END"
_ROUTE = f"""
SELECT id, event_type, payload, status,
       CASE WHEN event_type = 'withdrawal.webhook' AND NOT {_OK} THEN 'invalid'
            WHEN event_type = 'withdrawal.webhook'
             AND json_extract_string(payload, '$.event') = 'transfer.success' THEN 'transfer_success'
            WHEN event_type = 'withdrawal.webhook'
             AND json_extract_string(payload, '$.event') IN ('transfer.failed', 'transfer.reversed')
            THEN 'transfer_failed'
            WHEN event_type = 'deposit.transfer' THEN 'deposit'
            ELSE 'unhandled' END AS handler
FROM fx_webhooks"""


@register("route_events", oracle=f"SELECT id, handler FROM ({_ROUTE})")
def q_route_events(spark, d):
    return O.route_events(_hooks(Inputs(spark, d))).select("id", "handler")


@register("update_webhook_status", oracle=f"""
WITH r AS ({_ROUTE}),
res AS (SELECT id, CASE WHEN handler IN ('invalid', 'unhandled') THEN 'failed' ELSE 'success' END
               AS new_status,
               CASE WHEN handler = 'invalid' THEN 'decoding withdrawal webhook'
                    WHEN handler = 'unhandled' THEN 'unhandled event' END AS err
        FROM r WHERE status = 'pending')
SELECT w.id, COALESCE(res.new_status, w.status) AS status,
       CASE WHEN res.new_status = 'success' THEN cast('{_NOW}' AS timestamp) END AS processed_at,
       CASE WHEN res.id IS NOT NULL THEN res.err END AS error_message
FROM fx_webhooks w LEFT JOIN res ON res.id = w.id
""")
def q_update_webhook_status(spark, d):
    hooks = _hooks(Inputs(spark, d))
    routed = O.route_events(hooks).filter(F.col("status") == "pending")
    bad = F.col("handler").isin("invalid", "unhandled")
    results = routed.select(
        "id", F.when(bad, "failed").otherwise("success").alias("status"),
        F.when(F.col("handler") == "invalid", "decoding withdrawal webhook")
        .when(F.col("handler") == "unhandled", "unhandled event").alias("error_message"))
    return O.update_webhook_status(hooks, results, _NOW).select(
        "id", "status", "processed_at", "error_message")


@register("dedupe_webhooks", oracle="""
SELECT id FROM (
  SELECT id, row_number() OVER (PARTITION BY provider, external_event_id
                                ORDER BY created_at, id) AS rn
  FROM fx_webhooks WHERE external_event_id IS NOT NULL) WHERE rn = 1
UNION ALL SELECT id FROM fx_webhooks WHERE external_event_id IS NULL
""")
def q_dedupe_webhooks(spark, d):
    return O.dedupe_webhooks(_hooks(Inputs(spark, d))).select("id")

