"""Snapshots of a table with two levels of digests, and their difference.

A snapshot is written in buckets of a hash of its key, one folder each, next to a small table with the digest
of every bucket. Two snapshots are compared from the digests first: a bucket whose digests agree holds the
same rows and is never read. Of the others only the rows' keys and digests are joined, and only rows that differ
carry their columns on. So comparing two states of an archive costs what has changed, not what there is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.sources.ledger_io import audit_from_snapshots

BUCKETS = 4096


def row_digest(cols: Sequence[str]) -> Column:
    """128-bit digest of a row: every column with a marker of being null."""
    marked = [x for c in sorted(cols) for x in (F.col(c).isNull(), F.col(c))]
    return F.struct(F.xxhash64(*marked).alias("one"), F.xxhash64(F.lit(1), *marked).alias("two"))


def write_snapshot(df: DataFrame, location: str, key: str = "id", buckets: int = BUCKETS) -> None:
    """Write ``df`` as ``rows/bucket=<k>`` and ``digests`` (bucket, n, one, two) under ``location``.

    A bucket's digest is the exclusive or and the number of its rows' digests, added up before the shuffle,
    so it does not depend on order, files or partitions; repeated rows are told apart by their number and sum.
    """
    spread = df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    (spread.repartition("bucket").sortWithinPartitions("bucket", key)
     .write.mode("overwrite").partitionBy("bucket").parquet(f"{location}/rows"))
    df.limit(0).write.mode("overwrite").parquet(f"{location}/schema")      # an empty snapshot has no files
    d = row_digest(df.columns)
    digests = spread.select("bucket", d.alias("d")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("d.one").alias("one"),
        F.sum(F.col("d.two").cast("decimal(38,0)")).alias("two"))
    digests.coalesce(1).write.mode("overwrite").parquet(f"{location}/digests")


def changed_buckets(spark: SparkSession, before: str, after: str) -> list[int]:
    """Buckets whose digests differ (at most the number of buckets, a parameter of the layout)."""
    b, a = (spark.read.parquet(f"{where}/digests") for where in (before, after))
    same = b.join(a, ["bucket", "n", "one", "two"], "left_semi").select("bucket")
    every = b.select("bucket").union(a.select("bucket")).distinct()
    return sorted(r.bucket for r in every.join(same, "bucket", "left_anti").collect())


def _rows(spark: SparkSession, where: str, buckets: list[int]) -> DataFrame:
    schema = T.StructType([*spark.read.parquet(f"{where}/schema").schema.fields, T.StructField("bucket", T.IntegerType())])
    return spark.read.schema(schema).parquet(f"{where}/rows").filter(F.col("bucket").isin(buckets)).drop("bucket")


def changed_rows(spark: SparkSession, before: str, after: str, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """The rows of both snapshots whose key is new, gone or has another digest now (``key`` is unique in each)."""
    buckets = changed_buckets(spark, before, after)
    b, a = _rows(spark, before, buckets), _rows(spark, after, buckets)
    cols = b.columns
    digest = lambda df, x: df.select(key, row_digest(cols).alias(x))
    j = digest(b, "was").join(digest(a, "now"), key, "full_outer")
    keys = j.filter(~F.col("was").eqNullSafe(F.col("now"))).select(key)
    return b.join(keys, key, "left_semi"), a.join(keys, key, "left_semi")


def audit_between(spark: SparkSession, before: str, after: str, entity_type: str, key: str = "id", **kw) -> DataFrame:
    """A7 between two written snapshots, from the changed buckets only."""
    b, a = changed_rows(spark, before, after, key)
    return audit_from_snapshots(b, a, key, entity_type, **kw)


def append_only_violations(spark: SparkSession, before: str, after: str, key: str = "id",
                           table: str = "journal_lines") -> DataFrame:
    """C8 between two written snapshots: rows of an immutable table that were updated or deleted."""
    b, a = changed_rows(spark, before, after, key)
    j = b.select(key).join(a.select(key, F.lit(True).alias("there")), key, "left")
    return j.select(F.when(F.col("there"), "updated").otherwise("deleted").alias("rule"),
                    F.lit(table).alias("table_name"), F.col(key).alias("key"),
                    F.lit(None).cast("string").alias("detail"))
