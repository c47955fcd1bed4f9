"""Structured Streaming jobs (A2, I1-I4, I6, I8, I9); the stateful ones are in ``stateful``.

Every sink is written with ``foreachBatch`` into a folder keyed by the batch id
(``.../batch_id=N``) with overwrite, so a micro-batch replayed after a failure
rewrites exactly its own files (idempotent, exactly-once together with the
checkpointed source offsets). Readers take the latest version per key.

Event times from the parquet inputs are ``timestamp_ntz``; watermarks need
``timestamp``, so event-time columns are turned into instants reading the wall
time as UTC on the way in and back into UTC wall time on the way out
(``utc_instant`` / ``utc_wall``): results and window boundaries do not depend
on the session time zone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallybook.functions.text import utc_instant, utc_wall
from tallybook.operators import outbox as O
from tallybook.sources.messages import webhooks_from_messages

DEDUPE_WINDOW = "24 hours"
BACKLOG_LIMIT = 50


# ---------------------------------------------------------------- sources (A2)

def read_requests(spark: SparkSession, fmt: str = "kafka", topics: Sequence[str] = (),
                  path: str | None = None, schema: T.StructType | None = None,
                  options: dict | None = None) -> DataFrame:
    """A2: request/callback messages as a stream, from the start, committed records only.

    ``fmt='kafka'``: subscribe to ``topics`` with startingOffsets=earliest and
    kafka.isolation.level=read_committed; offsets live in the query checkpoint
    (at-least-once into idempotent sinks). Returns message_id, topic, message_key,
    value, timestamp. ``fmt='json'|'parquet'``: a file source with a declared schema.
    """
    if fmt == "kafka":
        r = (spark.readStream.format("kafka").option("subscribe", ",".join(topics))
             .option("startingOffsets", "earliest")
             .option("kafka.isolation.level", "read_committed"))
        for k, v in (options or {}).items():
            r = r.option(k, v)
        raw = r.load()
        return raw.select(
            F.concat_ws(":", "topic", F.col("partition").cast("string"),
                        F.col("offset").cast("string")).alias("message_id"),
            "topic", F.col("key").cast("string").alias("message_key"),
            F.col("value").cast("string").alias("value"),
            F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))
    r = spark.readStream.schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.format(fmt).load(path)


# ---------------------------------------------------------------- sinks

def batch_sink(path: str, partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer: ``<path>/batch_id=<id>`` overwritten per batch (replay-safe)."""
    def write(df: DataFrame, batch_id: int) -> None:
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{path}/batch_id={batch_id}")
    return write


def read_sink(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All batches of a batch-keyed sink (``batch_id`` column from the folder name)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.option("basePath", path).parquet(f"{path}/batch_id=*")


def latest_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert view of an update-mode sink: the row of the highest batch per key."""
    cols = [c for c in df.columns if c not in keys and c != "batch_id"]
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*cols), F.col("batch_id")).alias("_r"))
            .select(*keys, "_r.*"))


def run(writer, checkpoint: str, trigger: dict | None = None, output_mode: str = "append"
        ) -> StreamingQuery:
    """Start a foreachBatch query; ``trigger`` defaults to availableNow (process all, stop)."""
    w = writer.outputMode(output_mode).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


# ---------------------------------------------------------------- I1 / I2

def stream_intake(messages: DataFrame, out: str, rejects: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Messages → pending incoming_webhooks rows (A8); bad JSON → reject sink."""
    def each(df: DataFrame, batch_id: int) -> None:
        rows, bad = webhooks_from_messages(df)
        batch_sink(out)(rows, batch_id)
        batch_sink(rejects)(bad, batch_id)
    return run(messages.writeStream.foreachBatch(each), checkpoint, trigger)


def stream_route(hooks: DataFrame, out: str, checkpoint: str, trigger: dict | None = None
                 ) -> StreamingQuery:
    """One stream of webhook rows → per-handler folders (H8), one pass over the data."""
    routed = O.route_events(hooks)
    return run(routed.writeStream.foreachBatch(batch_sink(out, ["handler"])), checkpoint,
               trigger)


# ---------------------------------------------------------------- I3

def stream_dedupe(hooks: DataFrame, event_time: str = "created_at",
                  within: str = DEDUPE_WINDOW) -> DataFrame:
    """Drop repeated callbacks (same provider and external id) arriving within ``within``.

    State is kept per key until the watermark passes the first arrival + ``within``
    (``dropDuplicatesWithinWatermark``), so it stays bounded by one window of keys. Callbacks
    without an external id have nothing to be compared by and pass, outside the state.
    """
    known = (hooks.filter(F.col("external_event_id").isNotNull())
             .withColumn("_et", utc_instant(event_time)).withWatermark("_et", within)
             .dropDuplicatesWithinWatermark(["provider", "external_event_id"]).drop("_et"))
    return known.unionByName(hooks.filter(F.col("external_event_id").isNull()))


# ---------------------------------------------------------------- I4

def stream_balances(lines: DataFrame, accounts: DataFrame,
                    kinds: Sequence[str] = ("ledger", "available")) -> DataFrame:
    """I4: continuously maintained ledger balance per (account, currency) from posted lines.

    A stream-static join for the normal side, then a streaming aggregate: partial
    aggregation per micro-batch, running totals in the state store (one row per
    key). Run in update mode; ``latest_per_key`` of the sink is the projection.
    """
    normal = accounts.select(F.col("id").alias("account_id"), "ledger_normal_side")
    signed = F.when(F.col("side") == F.col("ledger_normal_side"), F.col("amount")) \
        .otherwise(-F.col("amount"))
    return (lines.filter(F.col("balance_kind").isin(list(kinds)))
            .join(normal, "account_id")
            .groupBy("account_id", "currency_code")
            .agg(F.sum(signed).cast("decimal(38,8)").alias("ledger_balance"),
                 F.count(F.lit(1)).alias("n_lines")))


# ---------------------------------------------------------------- I6

def stream_settle(withdrawals: DataFrame, callbacks: DataFrame, within: str = "24 hours",
                  late: str = "1 hour", how: str = "inner") -> DataFrame:
    """Withdrawals joined to their provider callbacks arriving within ``within``.

    Stream-stream interval join with watermarks on both sides (state is dropped
    once the watermark passes request time + ``within``); ``how='left_outer'``
    also emits withdrawals that got no callback in time (after the watermark
    passes their window) — the expired, unresolved ones.
    """
    w = (withdrawals.select(F.col("request_id").alias("w_id"),
                            utc_instant("requested_at").alias("w_ts"),
                            "source_account_id", "amount")
         .withWatermark("w_ts", late))
    c = (callbacks.select("hook_id", F.col("data.reference").alias("c_ref"), "event",
                          utc_instant("received_at").alias("c_ts"))
         .withWatermark("c_ts", late))
    cond = ((F.col("c_ref") == F.col("w_id")) & (F.col("c_ts") >= F.col("w_ts"))
            & (F.col("c_ts") <= F.col("w_ts") + F.expr(f"INTERVAL {within}")))
    j = w.join(c, cond, how)
    return j.select("w_id", "hook_id", "event", "source_account_id", "amount",
                    utc_wall("w_ts").alias("requested_at"),
                    utc_wall("c_ts").alias("received_at"))


# ---------------------------------------------------------------- I8

def stream_outbox(outbox_changes: DataFrame, topic_path: str, state_path: str,
                  checkpoint: str, deliver: Callable[[DataFrame], DataFrame] | None = None,
                  now: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """I8: publish each micro-batch of due outbox events (A3 to JSON files per topic, or a
    custom ``deliver`` returning (id, delivered, error_code, error_message)), then apply the
    delivery results (H2-H4) and write the new outbox states. Due events are H1's at ``now`` (default:
    the newest updated_at of the batch); the others come out unchanged."""
    from tallybook.sources.messages import outbox_messages

    def each(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        at = now or df.agg(F.max("updated_at").cast("string")).first()[0] or "1970-01-01 00:00:00"
        due = df.filter(O.is_due(at))
        msgs = outbox_messages(due)
        msgs.write.mode("overwrite").partitionBy("topic").json(f"{topic_path}/batch_id={batch_id}")
        results = (deliver(due) if deliver is not None
                   else due.select("id", F.lit(True).alias("delivered"),
                                   F.lit(None).cast("string").alias("error_code"),
                                   F.lit(None).cast("string").alias("error_message")))
        results = results.persist()      # one delivery, whatever reads its results
        new_state = O.apply_delivery(df, results, at)
        batch_sink(state_path)(new_state, batch_id)
        results.unpersist()
        df.unpersist()
    return run(outbox_changes.writeStream.foreachBatch(each), checkpoint, trigger)


# ---------------------------------------------------------------- I9

def backlog_windows(events: DataFrame, event_time: str = "ts", channel: str = "channel",
                    size: str = "1 minute", slide: str | None = None, late: str = "10 minutes",
                    limit: int = BACKLOG_LIMIT) -> DataFrame:
    """Arrivals per channel and time window (tumbling, or sliding with ``slide``), flagged
    when above ``limit`` (the backlog at which the reference starts a second worker)."""
    e = events.withColumn("_et", utc_instant(event_time)).withWatermark("_et", late)
    w = F.window("_et", size, slide) if slide else F.window("_et", size)
    return (e.groupBy(F.col(channel).alias("channel"), w.alias("w"))
            .agg(F.count(F.lit(1)).alias("arrivals"))
            .select("channel", utc_wall("w.start").alias("window_start"),
                    utc_wall("w.end").alias("window_end"), "arrivals",
                    (F.col("arrivals") > limit).alias("backlog")))


__all__ = ["read_requests", "batch_sink", "read_sink", "latest_per_key", "run", "stream_intake",
           "stream_route", "stream_dedupe", "stream_balances", "stream_settle",
           "stream_outbox", "backlog_windows"]
