"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.session import stage

ROW = "__tb_row"      # internal row number of staged documents


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a scale-factor folder, through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m") -> Iterator[None]:
    """Arrow batches of ``size`` for what is run inside; the session's setting comes back after."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def bucket_of_id(col: str, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n`` (the fold rule of the learned operators)."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(n)).cast("int")


def with_rows(docs: DataFrame, tag: str) -> DataFrame:
    """``docs`` staged with a unique row number, so that rows with null or repeated ids can be
    kept or dropped one by one."""
    return stage(docs.withColumn(ROW, F.monotonically_increasing_id()), tag)


def without(docs: DataFrame, losers: DataFrame, most: int = 1_000_000) -> DataFrame:
    """``docs`` (from :func:`with_rows`) without the row numbers in ``losers``.

    The numbers are written first. Up to ``most`` of them (8 bytes each) go to every task, so that no text
    moves; beyond that both sides are joined by shuffle.
    """
    gone = stage(losers.select(ROW), "row-numbers")
    if gone.count() <= most:
        gone = F.broadcast(gone)
    return docs.join(gone, ROW, "left_anti").drop(ROW)
