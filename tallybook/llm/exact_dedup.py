"""Exact dedup by a tree-merge of sorted digest runs (DataFrame functions only).

Level 0: every input partition is one run; its rows are reduced to one entry per digest
(winner, number of rows). Round k: the runs whose numbers agree after dropping the last k
base-``fan_in`` digits meet at the lowest of them (the binomial exchange, ``fan_in`` at a time)
and are merged on (run, digest); each merge keeps the winner and adds the counts. The last
round leaves one run, spread over the cluster by digest. The verdict then goes back down the
same tree, so no join ever meets more than ``fan_in`` copies of a digest per run (the last join:
one run's copies), however many copies the corpus holds.

An entry is verified at every merge: its key is SHA-256 plus the byte length and a second,
independent 64-bit hash, so two texts that agree in one digest alone stay apart.

Rules: null text counts as empty; empty texts equal each other; texts compare after lower-casing
A-Z only. Of equal texts the largest (or smallest) id stays, a null id only if no other row has
one; among repeated ids one row stays. Extra columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import ROW, text_or_empty, with_rows, without
from tallybook.session import stage

KEY = ["digest", "check", "n_bytes"]


def _digests(docs: DataFrame, id_col: str, text_col: str, row) -> DataFrame:
    norm = F.translate(text_or_empty(text_col), string.ascii_uppercase, string.ascii_lowercase)
    return (docs.select(F.col(id_col).alias("doc_id"), norm.alias("t"), row.alias("row"))
            .select("doc_id", "row", F.spark_partition_id().alias("run"),
                    F.unhex(F.sha2(F.col("t"), 256)).alias("digest"),
                    F.xxhash64("t").alias("check"), F.octet_length("t").alias("n_bytes")))


def _merge(runs: DataFrame, best) -> DataFrame:
    return runs.groupBy("run", *KEY).agg(best("win").alias("win"), F.sum("n").alias("n"))


def resolve(entries: DataFrame, keep: str = "largest", fan_in: int = 16) -> DataFrame:
    """Staged (doc_id, row, run, digest key) → the same rows with ``win`` and ``n`` of the group."""
    # Ids of any ordered type: the greatest known id by maximum, the least by minimum, unknown ones last.
    best, known = (F.max, F.col("doc_id").isNotNull()) if keep == "largest" else (F.min, F.col("doc_id").isNull())
    last = entries.agg(F.max("run")).first()[0] or 0
    rounds = 1
    while fan_in ** rounds <= last:
        rounds += 1
    level = _merge(entries.withColumn("win", F.struct(known.alias("known"), F.col("doc_id").alias("rank"), F.col("row")))
                   .withColumn("n", F.lit(1).cast("long")), best)
    levels = [level]
    for _ in range(rounds):
        level = _merge(level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int")), best)
        levels.append(level)
    verdict = levels.pop()
    for lower in reversed(levels):
        up = verdict.select(F.col("run").alias("up"), *KEY, "win", "n")
        verdict = (lower.select("run", *KEY, F.floor(F.col("run") / fan_in).cast("int").alias("up"))
                   .join(up, ["up", *KEY]).drop("up"))
    return (entries.join(verdict, ["run", *KEY])
            .withColumn("keep_id", F.col("win.rank")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "largest", row_col: str | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 and the row number.

    ``keep``: which id of equal texts stays, ``largest`` or ``smallest``.
    """
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    entries = stage(_digests(docs, id_col, text_col, row), "exact-digests")
    out = resolve(entries, keep)
    return out.select(
        "doc_id", F.col("keep_id").cast(entries.schema["doc_id"].dataType).alias("keep_id"),
        F.col("n").alias("group_size"), (F.col("win.row") == F.col("row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), F.col("row").alias(ROW))


def drop_exact_copies(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """``docs`` with one row of every group of equal texts, all its columns unchanged."""
    rows = with_rows(docs, "exact-docs")
    losers = exact_dedup(rows, keep=keep, row_col=ROW).filter(~F.col("kept")).select(ROW)
    return without(rows, losers)
