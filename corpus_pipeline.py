"""Corpus pipeline over ``documents``: quality classifier, exact dedup, near-dedup, benchmark
decontamination, packing. Every stage's result is written as Parquet and read again.

Each stage function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybook.llm import decontaminate, exact_dedup, near_dup, packing, quality
from tallybook.llm.common import table
from tallybook.llm.queries import tokenizer_file
from tallybook.session import stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents the quality classifier scores below 0.7."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.score_column(model) >= 0.7)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every group of equal texts (A-Z lower-cased), the one with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every group linked at 0.8 on five-word shingles, the smallest id."""
    return near_dup.drop_near_copies(docs, shingle=5, limit=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_file())


STAGES = [("quality", keep_good), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("decontamination", drop_contaminated), ("packing", pack)]

#: The classifier and the packer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, fn) in enumerate(STAGES):
        docs = fn(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
