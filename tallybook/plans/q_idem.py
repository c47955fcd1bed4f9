"""Registered idempotency queries (F13-F15) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.operators import idempotency as I
from tallybook.plans.inputs import Inputs
from tallybook.plans.registry import register
from tallybook.schemas import IDEMPOTENCY_KEYS, conform

_EXPIRE_NOW = "2024-01-02 12:00:00"


def _batch(x: Inputs):
    return x.raw("fx_request_bodies")


def _keys(x: Inputs):
    return conform(x.raw("fx_idem_keys"), IDEMPOTENCY_KEYS)


_REQ = f"""
r AS (SELECT request_id, scope, idempotency_key, sha2(body, 256) AS h, arrival
      FROM fx_request_bodies),
f AS (SELECT scope, idempotency_key, request_id AS first_id, h AS first_h FROM (
        SELECT *, row_number() OVER (PARTITION BY scope, idempotency_key
                                     ORDER BY arrival, request_id) AS rn FROM r) WHERE rn = 1)"""


@register("classify_requests", oracle=f"""
WITH {_REQ}
SELECT r.request_id, r.scope, r.idempotency_key, r.h AS request_hash,
       CASE WHEN k.request_hash IS NOT NULL AND r.h <> k.request_hash THEN 'conflict'
            WHEN k.request_hash IS NOT NULL AND k.response_code IS NOT NULL THEN 'replay'
            WHEN k.request_hash IS NOT NULL THEN 'in_progress'
            WHEN r.request_id = f.first_id THEN 'new'
            WHEN r.h = f.first_h THEN 'replay' ELSE 'conflict' END AS status,
       CASE WHEN k.request_hash IS NULL AND r.request_id <> f.first_id AND r.h = f.first_h
            THEN f.first_id END AS replay_of,
       CASE WHEN k.request_hash IS NOT NULL AND r.h = k.request_hash THEN k.response_code END
           AS response_code
FROM r JOIN f USING (scope, idempotency_key)
LEFT JOIN fx_idem_keys k ON k.scope = r.scope AND k.idempotency_key = r.idempotency_key
""")
def q_classify_requests(spark, d):
    x = Inputs(spark, d)
    return I.classify_requests(_batch(x), _keys(x)).select(
        "request_id", "scope", "idempotency_key", "request_hash", "status", "replay_of",
        "response_code")


@register("expire_keys", oracle=f"""
SELECT id, CASE WHEN response_code IS NULL AND locked_at IS NOT NULL
                 AND locked_at + INTERVAL '5 minutes' <= cast('{_EXPIRE_NOW}' AS timestamp)
            THEN NULL ELSE locked_at END AS locked_at, expires_at
FROM fx_idem_keys WHERE expires_at > cast('{_EXPIRE_NOW}' AS timestamp)
""")
def q_expire_keys(spark, d):
    kept, _ = I.expire_keys(_keys(Inputs(spark, d)), _EXPIRE_NOW)
    return kept.select("id", "locked_at", "expires_at")


@register("upsert_keys", oracle=f"""
WITH {_REQ},
a AS (SELECT scope, idempotency_key, min(arrival) AS first_at, max(arrival) AS last_at
      FROM r GROUP BY scope, idempotency_key),
j AS (SELECT COALESCE(k.scope, a.scope) AS scope,
             COALESCE(k.idempotency_key, a.idempotency_key) AS idempotency_key,
             k.id, k.request_hash, k.locked_at, k.expires_at, k.created_at, k.updated_at,
             a.first_at, a.last_at, f.first_h
      FROM fx_idem_keys k FULL OUTER JOIN a
        ON k.scope = a.scope AND k.idempotency_key = a.idempotency_key
      LEFT JOIN f ON f.scope = a.scope AND f.idempotency_key = a.idempotency_key)
SELECT COALESCE(id, concat('IDK-', scope, '-', idempotency_key)) AS id, scope, idempotency_key,
       CASE WHEN id IS NOT NULL THEN request_hash ELSE first_h END AS request_hash,
       CASE WHEN last_at IS NOT NULL THEN last_at ELSE locked_at END AS locked_at,
       CASE WHEN last_at IS NOT NULL THEN last_at + INTERVAL '24 hours' ELSE expires_at END
           AS expires_at,
       CASE WHEN id IS NOT NULL THEN created_at ELSE first_at END AS created_at
FROM j
""")
def q_upsert_keys(spark, d):
    x = Inputs(spark, d)
    return I.upsert_keys(_keys(x), _batch(x)).select(
        "id", "scope", "idempotency_key", "request_hash", "locked_at", "expires_at", "created_at")


@register("save_responses", oracle="""
SELECT id, COALESCE(response_code, 201) AS response_code,
       COALESCE(response_body, '{"status":"done"}') AS response_body
FROM fx_idem_keys
""")
def q_save_responses(spark, d):
    keys = _keys(Inputs(spark, d))
    first = keys.filter(F.col("response_code").isNull()).select(
        "id", F.lit(102).alias("response_code"), F.lit('{"status":"running"}').alias("response_body"),
        F.lit(1).alias("seq"))
    last = first.select("id", F.lit(201).alias("response_code"),
                        F.lit('{"status":"done"}').alias("response_body"), F.lit(2).alias("seq"))
    resp = last.unionByName(first)
    return I.save_responses(keys, resp).select("id", "response_code", "response_body")
