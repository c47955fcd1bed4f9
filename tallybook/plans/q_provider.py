"""Registered provider analytics queries (J1-J3, E11) with their DuckDB oracles."""

from __future__ import annotations

from tallybook.operators import provider as PR
from tallybook.plans.inputs import Inputs
from tallybook.plans.registry import register
from tallybook.session import stage

_STATUS_AT = "2024-01-15 00:00:00"


@register("first_success", oracle="""
SELECT request_id,
       arg_min(provider, priority) FILTER (WHERE success) AS provider,
       bool_or(success) AS success,
       CASE WHEN NOT bool_or(success)
            THEN arg_max(error_message, priority) FILTER (WHERE NOT success) END AS error_message,
       count(*) AS n_attempts
FROM fx_attempts GROUP BY request_id
""")
def q_first_success(spark, d):
    return PR.first_success(Inputs(spark, d).raw("fx_attempts"))


_SPANS = """
WITH o AS (
  SELECT *, cast(SUM(CASE WHEN success THEN 1 ELSE 0 END) OVER w AS bigint) AS cum_success,
            cast(SUM(CASE WHEN success THEN 0 ELSE 1 END) OVER w AS bigint) AS cum_failure
  FROM fx_attempts
  WINDOW w AS (PARTITION BY provider ORDER BY attempted_at, request_id, priority
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
f AS (SELECT * FROM o WHERE NOT success),
runs AS (SELECT provider, cum_success AS island, count(*) AS n_failures,
                min(attempted_at) AS started_at, min(cum_failure) AS f0
         FROM f GROUP BY provider, cum_success HAVING count(*) >= 3),
spans AS (
  SELECT r.provider, r.island, r.started_at, f.attempted_at AS opened_at, s.attempted_at AS closed_at,
         r.n_failures, f.attempted_at + INTERVAL '10 seconds' AS breaker_until
  FROM runs r
  JOIN f ON f.provider = r.provider AND f.cum_success = r.island AND f.cum_failure = r.f0 + 2
  LEFT JOIN (SELECT * FROM o WHERE success) s
    ON s.provider = r.provider AND s.cum_success = r.island + 1)"""


@register("outage_spans", oracle=_SPANS + """
SELECT * FROM spans
""")
def q_outage_spans(spark, d):
    return PR.outage_spans(Inputs(spark, d).raw("fx_attempts"))


@register("provider_status", oracle=_SPANS.replace(
    "FROM fx_attempts",
    f"FROM fx_attempts WHERE attempted_at <= cast('{_STATUS_AT}' AS timestamp)") + f""",
last AS (SELECT provider, arg_max(opened_at, opened_at) AS opened_at,
                arg_max(closed_at, opened_at) AS closed_at,
                arg_max(breaker_until, opened_at) AS breaker_until
         FROM spans GROUP BY provider),
p AS (SELECT DISTINCT provider FROM fx_attempts)
SELECT p.provider,
       CASE WHEN last.opened_at IS NOT NULL
             AND (last.closed_at IS NULL OR last.closed_at > cast('{_STATUS_AT}' AS timestamp))
             AND cast('{_STATUS_AT}' AS timestamp) < last.breaker_until THEN 'open'
            WHEN last.opened_at IS NOT NULL
             AND (last.closed_at IS NULL OR last.closed_at > cast('{_STATUS_AT}' AS timestamp))
            THEN 'half-open'
            ELSE 'closed' END AS state,
       last.opened_at AS last_opened_at
FROM p LEFT JOIN last ON last.provider = p.provider
""")
def q_provider_status(spark, d):
    return PR.provider_status(Inputs(spark, d).raw("fx_attempts"), _STATUS_AT)


@register("sla_report", oracle="""
WITH b AS (SELECT provider, latency_ms AS lat, success, attempted_at FROM fx_attempts
           UNION ALL SELECT '*', latency_ms, success, attempted_at FROM fx_attempts),
s AS (SELECT provider, lat, row_number() OVER (PARTITION BY provider ORDER BY lat) - 1 AS idx,
             count(*) OVER (PARTITION BY provider) AS n FROM b),
p AS (SELECT provider,
             min(lat) FILTER (WHERE idx = least(floor(n * 50 / 100), n - 1)) AS p50_ms,
             min(lat) FILTER (WHERE idx = least(floor(n * 95 / 100), n - 1)) AS p95_ms,
             min(lat) FILTER (WHERE idx = least(floor(n * 99 / 100), n - 1)) AS p99_ms
      FROM s GROUP BY provider),
st AS (SELECT provider, count(*) AS n, count(*) FILTER (WHERE success) AS n_success,
              min(lat) AS min_ms, max(lat) AS max_ms, round(avg(lat), 6) AS avg_ms,
              epoch_us(max(attempted_at)) - epoch_us(min(attempted_at)) AS us
       FROM b GROUP BY provider)
SELECT st.provider, st.n, st.n_success, round(st.n_success * 100.0 / st.n, 6) AS success_pct,
       p.p50_ms, p.p95_ms, p.p99_ms, st.min_ms, st.max_ms, st.avg_ms,
       CASE WHEN st.us > 0 THEN round(st.n / (st.us / 1e6), 6) END AS throughput_rps,
       p.p50_ms <= 100.0 AS p50_pass, p.p95_ms <= 200.0 AS p95_pass, p.p99_ms <= 400.0 AS p99_pass,
       round(st.n_success * 100.0 / st.n, 6) >= 99.9 AS error_rate_pass,
       COALESCE(CASE WHEN st.us > 0 THEN round(st.n / (st.us / 1e6), 6) END >= 150.0, false)
           AS throughput_pass
FROM st JOIN p USING (provider)
""")
def q_sla_report(spark, d):
    return PR.sla_report(Inputs(spark, d).raw("fx_attempts"))


@register("sla_by_hour", oracle="""
SELECT provider, date_trunc('day', attempted_at) AS window_start, count(*) AS n,
       count(*) FILTER (WHERE success) AS n_success,
       round(count(*) FILTER (WHERE success) * 100.0 / count(*), 6) AS success_pct,
       min(lat) AS min_ms, max(lat) AS max_ms, round(sum(lat) / count(lat), 6) AS avg_ms
FROM (SELECT provider, attempted_at, success, cast(latency_ms AS double) AS lat FROM fx_attempts
      UNION ALL SELECT '*', attempted_at, success, cast(latency_ms AS double) FROM fx_attempts) x
GROUP BY 1, 2
""")
def q_sla_by_hour(spark, d):
    """Hourly sketches, written as a table, then merged to days; the percentiles are held against E11 in the tests."""
    sketches = stage(PR.latency_sketches(Inputs(spark, d).raw("fx_attempts")), "sla-sketches")
    return PR.sla_from_sketches(sketches, "day").drop("p50_ms", "p95_ms", "p99_ms")
