"""Idempotent request handling as set operations.

The reference checks one key at a time under a short lock. Here a whole
batch is classified at once: the first arrival per (scope, key) is found with
a ``min_by`` aggregate (skew-safe), every other arrival is compared with it
and with the key already stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.text import request_hash, ts_literal

KEY_TTL = "24 hours"
LOCK_TTL = "5 minutes"


def classify_requests(requests: DataFrame, keys: DataFrame, body: str = "body") -> DataFrame:
    """per request: ``new`` / ``replay`` / ``conflict`` / ``in_progress``.

    Against a stored key: same hash with a stored response → replay (the stored
    response is returned); same hash without a response → in_progress; other
    hash → conflict. Without a stored key: the first arrival in the batch is new,
    later arrivals replay it when their hash is equal, else conflict.
    """
    r = requests.withColumn("request_hash", request_hash(body))
    first = (r.groupBy("scope", "idempotency_key")
             .agg(F.min_by(F.struct(F.col("request_id").alias("first_request_id"),
                                    F.col("request_hash").alias("first_hash")),
                           F.struct("arrival", "request_id")).alias("_f"))
             .select("scope", "idempotency_key", "_f.*"))
    k = keys.select("scope", "idempotency_key", F.col("request_hash").alias("stored_hash"),
                    F.col("response_code").alias("stored_response_code"),
                    F.col("response_body").alias("stored_response_body"),
                    F.col("id").alias("idempotency_key_row_id"))
    j = r.join(first, ["scope", "idempotency_key"], "left").join(
        k, ["scope", "idempotency_key"], "left")
    stored = F.col("stored_hash").isNotNull()
    same_stored = F.col("request_hash") == F.col("stored_hash")
    status = (F.when(stored & ~same_stored, "conflict")
              .when(stored & F.col("stored_response_code").isNotNull(), "replay")
              .when(stored, "in_progress")
              .when(F.col("request_id") == F.col("first_request_id"), "new")
              .when(F.col("request_hash") == F.col("first_hash"), "replay")
              .otherwise("conflict"))
    replay_of = F.when(~stored & (F.col("request_id") != F.col("first_request_id"))
                       & (F.col("request_hash") == F.col("first_hash")),
                       F.col("first_request_id"))
    return j.select("request_id", "scope", "idempotency_key", "request_hash",
                    status.alias("status"), replay_of.alias("replay_of"),
                    F.when(stored & same_stored, F.col("stored_response_code"))
                    .alias("response_code"),
                    F.when(stored & same_stored, F.col("stored_response_body"))
                    .alias("response_body"))


def expire_keys(keys: DataFrame, now: str, lock_ttl: str = LOCK_TTL) -> tuple[DataFrame, DataFrame]:
    """drop keys past expires_at; clear processing locks older than ``lock_ttl`` that never
    got a response. Returns ``(kept, expired)``."""
    n = ts_literal(now)
    live = F.col("expires_at") > n
    kept = keys.filter(live)
    stale_lock = (F.col("response_code").isNull() & F.col("locked_at").isNotNull()
                  & (F.col("locked_at") + F.expr(f"INTERVAL {lock_ttl}") <= n))
    kept = kept.withColumn("locked_at", F.when(stale_lock, F.lit(None).cast("timestamp_ntz"))
                           .otherwise(F.col("locked_at")))
    return kept, keys.filter(~live)


def upsert_keys(keys: DataFrame, requests: DataFrame, body: str = "body",
                ttl: str = KEY_TTL) -> DataFrame:
    """Insert new (scope, key) rows; on conflict refresh only locked_at / expires_at
    (hash, response and created_at stay). Several requests of one key in the batch: the first
    sets the hash, the last sets the lock times — as if inserted one by one."""
    r = requests.withColumn("_hash", request_hash(body))
    order = F.struct("arrival", "request_id")
    agg = (r.groupBy("scope", "idempotency_key")
           .agg(F.min_by("_hash", order).alias("_first_hash"),
                F.min("arrival").alias("_first_at"),
                F.max("arrival").alias("_last_at")))
    j = keys.join(agg, ["scope", "idempotency_key"], "full_outer")
    old = F.col("id").isNotNull()
    new_seen = F.col("_last_at").isNotNull()
    exp = F.col("_last_at") + F.expr(f"INTERVAL {ttl}")
    return j.select(
        F.when(old, F.col("id")).otherwise(F.concat(F.lit("IDK-"), F.col("scope"), F.lit("-"),
                                                    F.col("idempotency_key"))).alias("id"),
        "idempotency_key", "scope",
        F.when(old, F.col("request_hash")).otherwise(F.col("_first_hash")).alias("request_hash"),
        "response_code", "response_body",
        F.when(new_seen, F.col("_last_at")).otherwise(F.col("locked_at")).alias("locked_at"),
        F.when(new_seen, exp).otherwise(F.col("expires_at")).alias("expires_at"),
        F.when(old, F.col("created_at")).otherwise(F.col("_first_at")).alias("created_at"),
        F.when(new_seen, F.col("_last_at")).otherwise(F.col("updated_at")).alias("updated_at"))


def save_responses(keys: DataFrame, responses: DataFrame) -> DataFrame:
    """Store response code and body by key id; of several responses the one with the highest
    ``seq`` wins (a required column: arrival order cannot be told from the codes)."""
    resp = responses.groupBy("id").agg(
        F.max_by(F.struct("response_code", "response_body"), F.col("seq")).alias("_r"))
    j = keys.join(resp.select(F.col("id").alias("_rid"), "_r"),
                  F.col("id") == F.col("_rid"), "left")
    hit = F.col("_rid").isNotNull()
    return j.select(*[F.when(hit, F.col("_r." + c)).otherwise(F.col(c)).alias(c)
                      if c in ("response_code", "response_body") else F.col(c)
                      for c in keys.columns])
