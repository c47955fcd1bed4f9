"""Outbox and incoming-webhook lifecycles (H1-H9).

Claims are global top-k (``orderBy().limit(n)`` → ``TakeOrderedAndProject``:
each partition keeps its own top n, one small merge) followed by a key join
back into the table; state changes are a left join of a result table plus
``when`` per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.text import json_is_object, ts_literal

CLAIM_BATCH = 100
STUCK_AFTER = "5 minutes"
MAX_RETRIES = 5


def _apply(df: DataFrame, ids: DataFrame, sets: dict[str, Column], extra: list[str] = ()
           ) -> DataFrame:
    """Rows whose id is in ``ids`` get the ``sets`` column values (may use ``ids``' columns)."""
    k = ids.withColumnRenamed("id", "_hit_id")
    j = df.join(k, F.col("id") == F.col("_hit_id"), "left")
    hit = F.col("_hit_id").isNotNull()
    return j.select(*[F.when(hit, sets[c]).otherwise(F.col(c)).alias(c) if c in sets
                      else F.col(c) for c in df.columns])


def is_due(now: str) -> Column:
    """Events to send at ``now``: pending or failed, and not waiting for a later retry."""
    return (F.col("status").isin("pending", "failed")
            & (F.col("next_retry_at").isNull() | (F.col("next_retry_at") <= ts_literal(now))))


def claim_events(outbox: DataFrame, now: str, n: int = CLAIM_BATCH) -> tuple[DataFrame, DataFrame]:
    """H1: the oldest ``n`` pending/failed events that are due → processing.
    Returns ``(outbox', claimed)``."""
    t = ts_literal(now)
    claimed_ids = (outbox.filter(is_due(now)).select("id", "created_at")
                   .orderBy("created_at", "id").limit(n).select("id"))
    out = _apply(outbox, claimed_ids, {"status": F.lit("processing"), "updated_at": t})
    claimed = out.join(claimed_ids, "id", "left_semi")
    return out, claimed


def mark_published(outbox: DataFrame, results: DataFrame, now: str) -> DataFrame:
    """H2: delivered events → published, published_at = now."""
    t = ts_literal(now)
    ok = results.filter(F.col("delivered")).select("id").distinct()
    return _apply(outbox, ok, {"status": F.lit("published"), "published_at": t})


def mark_failed(outbox: DataFrame, results: DataFrame, now: str,
                max_retries: int = MAX_RETRIES) -> DataFrame:
    """H3 + H4: undelivered events. retry_count > ``max_retries`` → dead_letter (terminal);
    otherwise failed, retry + 1, next_retry_at = now + 2^(old retry) seconds, error fields."""
    t = ts_literal(now)
    # At-least-once results may repeat an id: one row per event.
    bad = (results.filter(~F.col("delivered")).groupBy("id")
           .agg(F.max(F.struct("error_code", "error_message")).alias("_e"))
           .select("id", F.col("_e.error_code").alias("_ec"), F.col("_e.error_message").alias("_em")))
    dead = F.col("retry_count") > max_retries
    backoff = F.make_dt_interval(secs=F.pow(F.lit(2), F.col("retry_count")).cast("decimal(18,6)"))
    sets = {
        "status": F.when(dead, "dead_letter").otherwise("failed"),
        "retry_count": F.when(dead, F.col("retry_count")).otherwise(F.col("retry_count") + 1),
        "next_retry_at": F.when(dead, F.col("next_retry_at")).otherwise(t + backoff),
        "error_code": F.col("_ec"), "error_message": F.col("_em"), "updated_at": t}
    k = bad.withColumnRenamed("id", "_hit_id")
    j = outbox.join(k, F.col("id") == F.col("_hit_id"), "left")
    hit = F.col("_hit_id").isNotNull()
    return j.select(*[F.when(hit, sets[c]).otherwise(F.col(c)).alias(c) if c in sets
                      else F.col(c) for c in outbox.columns])


def dead_letter(outbox: DataFrame, results: DataFrame, max_retries: int = MAX_RETRIES
                ) -> DataFrame:
    """H4: the undelivered events that become dead letters (retry_count > ``max_retries``)."""
    bad = results.filter(~F.col("delivered")).select("id")
    return outbox.join(bad, "id", "left_semi").filter(F.col("retry_count") > max_retries) \
        .withColumn("status", F.lit("dead_letter"))


def apply_delivery(outbox: DataFrame, results: DataFrame, now: str,
                   max_retries: int = MAX_RETRIES) -> DataFrame:
    """H2-H4 in one pass: published / failed with backoff / dead_letter."""
    return mark_failed(mark_published(outbox, results, now), results, now, max_retries)


def reset_stuck(outbox: DataFrame, now: str, after: str = STUCK_AFTER) -> DataFrame:
    """H5: processing events untouched for ``after`` → pending, retry + 1."""
    t = ts_literal(now)
    stuck = (F.col("status") == "processing") & (F.col("updated_at") < t - F.expr(f"INTERVAL {after}"))
    sets = {"status": F.lit("pending"), "retry_count": F.col("retry_count") + 1, "updated_at": t}
    return outbox.select(*[F.when(stuck, sets[c]).otherwise(F.col(c)).alias(c) if c in sets
                           else F.col(c) for c in outbox.columns])


def claim_webhooks(hooks: DataFrame, n: int = CLAIM_BATCH) -> DataFrame:
    """H6: the oldest ``n`` pending webhooks (top-k)."""
    return hooks.filter(F.col("status") == "pending").orderBy("created_at", "id").limit(n)


def update_webhook_status(hooks: DataFrame, results: DataFrame, now: str) -> DataFrame:
    """H7: new status and error text; processed_at set when the new status is success or
    processed. Repeated results of one id count once: the highest ``seq`` where given, else the
    greatest (status, error)."""
    t = ts_literal(now)
    said = F.struct("status", "error_message")
    best = F.max_by(said, F.struct("seq", said)) if "seq" in results.columns else F.max(said)
    r = (results.groupBy("id").agg(best.alias("_r"))
         .select("id", F.col("_r.status").alias("_ns"), F.col("_r.error_message").alias("_ne")))
    k = r.withColumnRenamed("id", "_hit_id")
    j = hooks.join(k, F.col("id") == F.col("_hit_id"), "left")
    hit = F.col("_hit_id").isNotNull()
    sets = {"status": F.col("_ns"), "error_message": F.col("_ne"),
            "processed_at": F.when(F.col("_ns").isin("success", "processed"), t)
            .otherwise(F.col("processed_at")),
            "updated_at": t}
    return j.select(*[F.when(hit, sets[c]).otherwise(F.col(c)).alias(c) if c in sets
                      else F.col(c) for c in hooks.columns])


def route_events(hooks: DataFrame) -> DataFrame:
    """H8: handler per webhook: transfer_success / transfer_failed for withdrawal callbacks,
    deposit for deposit messages, invalid for unparsable callbacks, else unhandled."""
    ok = json_is_object("payload")
    ev = F.when(ok, F.get_json_object("payload", "$.event"))
    wd = F.col("event_type") == "withdrawal.webhook"
    handler = (F.when(wd & ~ok, "invalid")
               .when(wd & (ev == "transfer.success"), "transfer_success")
               .when(wd & ev.isin("transfer.failed", "transfer.reversed"), "transfer_failed")
               .when(F.col("event_type") == "deposit.transfer", "deposit")
               .otherwise("unhandled"))
    return hooks.withColumn("handler", handler)


def dedupe_webhooks(hooks: DataFrame) -> DataFrame:
    """H9: one row per (provider, external_event_id), the first by (created_at, id); rows with a
    null external id are all kept."""
    keyed = hooks.filter(F.col("external_event_id").isNotNull())
    firsts = (keyed.groupBy("provider", "external_event_id")
              .agg(F.min_by("id", F.struct("created_at", "id")).alias("_first")))
    kept = keyed.join(firsts.select(F.col("_first").alias("id")), "id", "left_semi")
    return kept.unionByName(hooks.filter(F.col("external_event_id").isNull()))
