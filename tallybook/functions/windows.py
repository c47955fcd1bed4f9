"""Skew-safe windows: two-level running sums, the next value after a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.session import stage


def chunked_running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                        values: dict[str, Column], chunk: Column | None = None,
                        inclusive: bool = True) -> DataFrame:
    """Add a running sum per ``keys`` in ``order`` for every ``values`` entry (name → column).

    One window over a whole key would put a hot key (a system account, a busy
    provider) into one task. Instead rows are cut into (key, chunk) groups.
    By default the rows are range partitioned by (keys, order) and written to the
    shared folder with their partition number as the chunk: chunks follow the
    volume, so a key is split however its rows cluster. A ``chunk`` given instead
    must be monotone in ``order``:
    1. per-chunk totals (partial + final aggregate);
    2. a window over the chunk totals (one row per chunk) gives each chunk's
       opening value;
    3. a window over (key, chunk) adds the running sum inside the chunk.
    The largest sorted group is one key's chunk, not its whole history.
    ``inclusive=False`` gives the sum of rows strictly before each row.
    """
    keys = list(keys)
    if chunk is None:
        x = stage(df.repartitionByRange(*keys, *order)
                  .withColumn("_chunk", F.spark_partition_id()), "chunks")
    else:
        x = df.withColumn("_chunk", chunk)
    for name, v in values.items():
        x = x.withColumn("_v_" + name, v)
    tot = x.groupBy(*keys, "_chunk").agg(*[F.sum("_v_" + n).alias("_t_" + n) for n in values])
    w_chunks = (Window.partitionBy(*keys).orderBy("_chunk")
                .rowsBetween(Window.unboundedPreceding, -1))
    opening = tot.select(*keys, "_chunk", *[
        F.coalesce(F.sum("_t_" + n).over(w_chunks), F.lit(0)).alias("_o_" + n) for n in values])
    frame_end = 0 if inclusive else -1
    w_in = (Window.partitionBy(*keys, "_chunk").orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, frame_end))
    for n in values:
        x = x.withColumn("_i_" + n, F.coalesce(F.sum("_v_" + n).over(w_in), F.lit(0)))
    x = x.join(opening, [*keys, "_chunk"])
    for n in values:
        x = x.withColumn(n, F.col("_o_" + n) + F.col("_i_" + n))
    drop = ["_chunk"] + [p + n for n in values for p in ("_v_", "_i_", "_o_")]
    return x.drop(*drop)


def chunked_next(df: DataFrame, keys: Sequence[str], order: str, value: Column, name: str) -> DataFrame:
    """Add the first non-null ``value`` that comes strictly after a row, per ``keys`` in ``order``.

    ``value`` must not fall along ``order`` (as the order column itself, where a condition holds), so the first is
    the least. Rows are cut into chunks of equal volume as in :func:`chunked_running_sum`: the answer is the least value
    later in the row's chunk, or that of the key's following chunks (one row per chunk).
    """
    keys = list(keys)
    x = stage(df.withColumn("_val", value).repartitionByRange(*keys, order)
              .withColumn("_chunk", F.spark_partition_id()), "chunks")
    later = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(1, Window.unboundedFollowing)
    follow = (x.groupBy(*keys, "_chunk").agg(F.min("_val").alias("_low"))
              .withColumn("_next", F.min("_low").over(later)).drop("_low"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    return (x.withColumn("_in", F.min("_val").over(inside)).join(follow, [*keys, "_chunk"])
            .withColumn(name, F.coalesce("_in", "_next")).drop("_val", "_chunk", "_in", "_next"))
