"""Provider analytics: failover outcome, outage spans, breaker state, SLA report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.text import ts_literal, utc_instant
from tallybook.functions.windows import chunked_running_sum

# Breaker defaults as configured (3 failures, 10 s) and the SLA targets.
BREAKER_THRESHOLD = 3
BREAKER_TIMEOUT_S = 10
SLA = {"p50_ms": 100.0, "p95_ms": 200.0, "p99_ms": 400.0, "success_pct": 99.9,
       "throughput_rps": 150.0}


def first_success(attempts: DataFrame) -> DataFrame:
    """Per request the first successful provider in priority order, else the last error."""
    return (attempts.groupBy("request_id")
            .agg(F.min_by(F.when(F.col("success"), F.col("provider")),
                          F.when(F.col("success"), F.col("priority"))).alias("provider"),
                 F.max_by("error_message", F.when(~F.col("success"), F.col("priority")))
                 .alias("_last_error"),
                 F.bool_or("success").alias("success"),
                 F.count(F.lit(1)).alias("n_attempts"))
            .select("request_id", "provider", "success",
                    F.when(~F.col("success"), F.col("_last_error")).alias("error_message"),
                    "n_attempts"))


def _ordered(attempts: DataFrame) -> DataFrame:
    order = [F.col("attempted_at"), F.col("request_id"), F.col("priority")]
    return chunked_running_sum(
        attempts, ["provider"], order,
        {"cum_success": F.col("success").cast("long"),
         "cum_failure": (~F.col("success")).cast("long")})


def outage_spans(attempts: DataFrame, threshold: int = BREAKER_THRESHOLD,
                 timeout_s: int = BREAKER_TIMEOUT_S) -> DataFrame:
    """Runs of ≥ ``threshold`` consecutive failures per provider (gaps and islands).

    island = successes so far; a failure run is the failures of one island. The
    breaker opens at the threshold-th failure of the run and the run is closed by
    the next success (null while still failing). ``breaker_until`` = opened_at +
    timeout.
    """
    x = _ordered(attempts)
    fails = x.filter(~F.col("success"))
    runs = (fails.groupBy("provider", F.col("cum_success").alias("island"))
            .agg(F.count(F.lit(1)).alias("n_failures"),
                 F.min("attempted_at").alias("started_at"),
                 F.min("cum_failure").alias("_f0"))
            .filter(F.col("n_failures") >= threshold))
    opened = (fails.select("provider", F.col("cum_success").alias("island"),
                           F.col("cum_failure").alias("_f"),
                           F.col("attempted_at").alias("opened_at")))
    runs = runs.join(opened, ["provider", "island"]).filter(
        F.col("_f") == F.col("_f0") + threshold - 1).drop("_f", "_f0")
    closers = x.filter(F.col("success")).select(
        "provider", (F.col("cum_success") - 1).alias("island"),
        F.col("attempted_at").alias("closed_at"))
    return (runs.join(closers, ["provider", "island"], "left")
            .select("provider", "island", "started_at", "opened_at", "closed_at", "n_failures",
                    (F.col("opened_at") + F.make_dt_interval(secs=F.lit(timeout_s)))
                    .alias("breaker_until")))


def provider_status(attempts: DataFrame, now: str, threshold: int = BREAKER_THRESHOLD,
                    timeout_s: int = BREAKER_TIMEOUT_S) -> DataFrame:
    """Breaker state per provider at ``now``: open (inside the timeout of an unresolved
    span), half-open (timeout passed, no success yet), closed."""
    t = ts_literal(now)
    providers = attempts.select("provider").distinct()
    spans = outage_spans(attempts.filter(F.col("attempted_at") <= t), threshold, timeout_s)
    last = (spans.groupBy("provider")
            .agg(F.max_by(F.struct("opened_at", "closed_at", "breaker_until"),
                          F.col("opened_at")).alias("_s")))
    j = providers.join(last, "provider", "left")
    unresolved = F.col("_s").isNotNull() & (F.col("_s.closed_at").isNull()
                                            | (F.col("_s.closed_at") > t))
    state = (F.when(unresolved & (t < F.col("_s.breaker_until")), "open")
             .when(unresolved, "half-open").otherwise("closed"))
    return j.select("provider", state.alias("state"),
                    F.col("_s.opened_at").alias("last_opened_at"))


def sla_report(attempts: DataFrame, latency: str = "latency_ms", exact: bool = True,
               accuracy: int = 10000) -> DataFrame:
    """Per provider and overall ('*'): p50/p95/p99 (element at floor(n·p/100) of the sorted
    latencies, clamped), min, max, avg, throughput, success %, SLA pass flags.

    Exact ranks without sorting all rows of a key: latencies are counted per distinct value and
    provider once (partial aggregate), '*' is added up from these counts, a cumulative count over
    volume chunks of the distinct values finds the elements at the three ranks in one aggregate.
    ``exact=False`` uses ``percentile_approx`` instead (a sketch; interpolation-free but
    approximate).
    """
    lat = F.col(latency).alias("lat")
    own = attempts.groupBy("provider").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("success").alias("n_success"),
        F.min(latency).alias("min_ms"), F.max(latency).alias("max_ms"),
        F.sum(latency).alias("_sum"), F.count(latency).alias("_known"),
        F.min("attempted_at").alias("_t0"), F.max("attempted_at").alias("_t1"))
    every = own.agg(F.lit("*").alias("provider"), F.sum("n").alias("n"),
                    F.sum("n_success").alias("n_success"), F.min("min_ms").alias("min_ms"),
                    F.max("max_ms").alias("max_ms"), F.sum("_sum").alias("_sum"),
                    F.sum("_known").alias("_known"), F.min("_t0").alias("_t0"),
                    F.max("_t1").alias("_t1")).filter(F.col("n") > 0)
    stats = own.unionByName(every).withColumn("avg_ms", F.round(F.col("_sum") / F.col("_known"), 6))
    ranks = (50, 95, 99)
    if exact:
        hist = attempts.select("provider", lat).groupBy("provider", "lat").agg(
            F.count(F.lit(1)).alias("_c"))
        hist = hist.unionByName(hist.groupBy("lat").agg(F.sum("_c").alias("_c"))
                                .withColumn("provider", F.lit("*")))
        cum = chunked_running_sum(hist, ["provider"], [F.col("lat")], {"_cum": F.col("_c")})
        cum = cum.join(stats.select("provider", "n"), "provider")
        at = {p: F.least(F.floor(F.col("n") * F.lit(p) / F.lit(100)), F.col("n") - 1) for p in ranks}
        picked = cum.groupBy("provider").agg(
            *[F.min(F.when(F.col("_cum") > at[p], F.col("lat"))).alias(f"p{p}_ms") for p in ranks])
    else:
        both = attempts.select("provider", lat).unionByName(
            attempts.select(F.lit("*").alias("provider"), lat))
        picked = (both.groupBy("provider")
                  .agg(F.percentile_approx("lat", [p / 100 for p in ranks], accuracy).alias("_p"))
                  .select("provider", *[F.col("_p")[k].alias(f"p{p}_ms") for k, p in enumerate(ranks)]))
    out = stats.join(picked, "provider", "left")
    secs = F.unix_micros(utc_instant("_t1")) - F.unix_micros(utc_instant("_t0"))
    rps = F.when(secs > 0, F.round(F.col("n") / (secs / F.lit(1e6)), 6))
    pct = F.round(F.col("n_success") * 100.0 / F.col("n"), 6)
    return out.select(
        "provider", "n", "n_success", pct.alias("success_pct"), "p50_ms", "p95_ms", "p99_ms",
        "min_ms", "max_ms", "avg_ms", rps.alias("throughput_rps"),
        (F.col("p50_ms") <= SLA["p50_ms"]).alias("p50_pass"),
        (F.col("p95_ms") <= SLA["p95_ms"]).alias("p95_pass"),
        (F.col("p99_ms") <= SLA["p99_ms"]).alias("p99_pass"),
        (pct >= SLA["success_pct"]).alias("error_rate_pass"),
        F.coalesce(rps >= SLA["throughput_rps"], F.lit(False)).alias("throughput_pass"))


#: Size parameter of the latency sketches. Its rank error is about 2.296 / k^0.9021 for one quantile
#: (the published bound of the sketch at 99 % confidence): 0.83 % at 512.
SKETCH_K = 512


def rank_error(k: int = SKETCH_K) -> float:
    """Normalised rank error of a sketch of size ``k``, at 99 % confidence."""
    return 2.296 / k ** 0.9021


def latency_sketches(attempts: DataFrame, latency: str = "latency_ms", k: int = SKETCH_K) -> DataFrame:
    """E11 in mergeable form: per provider and hour the counts and a KLL sketch of the latencies.

    Kept as a table, new hours are appended; any window, of any set of providers, is merged from its rows
    (:func:`sla_from_sketches`) without reading attempts again. Sketches are built map-side and merged, so a
    provider with a third of the attempts shuffles one sketch per task.
    """
    lat = F.col(latency).cast("double")
    return attempts.groupBy("provider", F.date_trunc("hour", "attempted_at").cast("timestamp_ntz").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("success").alias("n_success"), F.count(lat).alias("n_known"),
        F.sum(lat).alias("total_ms"), F.min(lat).alias("min_ms"), F.max(lat).alias("max_ms"),
        F.min("attempted_at").alias("first_at"), F.max("attempted_at").alias("last_at"),
        F.kll_sketch_agg_double(lat, F.lit(k)).alias("sketch"))


def sla_from_sketches(sketches: DataFrame, window: str | None = None, k: int = SKETCH_K) -> DataFrame:
    """E11 per provider and overall ('*') from :func:`latency_sketches` rows, per ``window`` (a truncation unit
    such as ``day``; none: all rows together): counts, success %, min, max, avg exact, p50 / p95 / p99 within
    :func:`rank_error` of their ranks."""
    by = [F.date_trunc(window, "hour").cast("timestamp_ntz").alias("window_start")] if window else []
    both = sketches.unionByName(sketches.withColumn("provider", F.lit("*")))
    merged = both.groupBy("provider", *by).agg(
        *[F.sum(c).alias(c) for c in ("n", "n_success", "n_known", "total_ms")], F.min("min_ms").alias("min_ms"),
        F.max("max_ms").alias("max_ms"), F.kll_merge_agg_double("sketch", k).alias("sketch"))
    q = F.kll_sketch_get_quantile_double("sketch", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    x = merged.withColumn("q", F.when(F.col("n_known") > 0, q))
    return x.select("provider", *(["window_start"] if window else []), "n", "n_success",
                    F.round(F.col("n_success") * 100.0 / F.col("n"), 6).alias("success_pct"),
                    *[F.col("q")[i].alias(f"p{p}_ms") for i, p in enumerate((50, 95, 99))], "min_ms", "max_ms",
                    F.round(F.col("total_ms") / F.col("n_known"), 6).alias("avg_ms"))
