"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has 2**16 equal cells. Every shard owns ``vnodes`` virtual nodes, each at a cell; a row
belongs to the cell of its id's hash and is at home on the first virtual node clockwise. A shard
takes at most its capacity: in ring order, every cell first fills its home shard; what does not
fit continues clockwise to the next virtual node whose shard has room. With ``load_factor`` 1
the capacities add up to exactly the number of rows, so counts differ by one at most (law
``rows``); a larger factor moves fewer rows and bounds every shard by ``factor * n / shards``.

Only the counts per cell (65,536 numbers whatever the data) reach the driver, which lays out the
ranges of each cell; the rows are ranked inside their cell by Spark, and joined to the ranges, a
table bounded by cells + virtual nodes + shards and therefore safe to broadcast. Texts are read once
and never shuffled.

Rules: null text has size 1 and the checksum of the empty text; a null id hashes to one cell;
rows with the same id share a cell and are ordered by checksum and size. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.windows import chunked_running_sum
from tallybook.llm.common import text_or_empty
from tallybook.session import stage

CELL_BITS = 16


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """Virtual nodes in ring order: (cell, shard)."""
    def place(s: int, v: int) -> int:
        h = hashlib.blake2b(f"shard {s} node {v}".encode(), digest_size=8).digest()
        return int.from_bytes(h, "big") >> (64 - CELL_BITS)
    return sorted((place(s, v), s) for s in range(shards) for v in range(vnodes))


def lay_out(counts: dict[int, int], shards: int, vnodes: int, load_factor: float) -> pd.DataFrame:
    """Ranges (cell, lo, hi, shard, base): ranks lo..hi-1 of a cell go to the shard, first slot base."""
    nodes = ring(shards, vnodes)
    total = sum(counts.values())
    if load_factor <= 1:
        cap = [total // shards + (s < total % shards) for s in range(shards)]
    else:
        cap = [-int(-load_factor * total // shards)] * shards
    room, used, out = list(cap), [0] * shards, []

    def put(cell: int, lo: int, hi: int, s: int) -> int:
        n = min(hi - lo, room[s])
        if n:
            out.append((cell, lo, lo + n, s, used[s]))
            room[s] -= n
            used[s] += n
        return lo + n

    left, at = [], 0
    for cell in sorted(counts):
        while at < len(nodes) and nodes[at][0] < cell:
            at += 1
        home = at % len(nodes)
        lo = put(cell, 0, counts[cell], nodes[home][1])
        if lo < counts[cell]:
            left.append((cell, home, lo))
    onward = list(range(len(nodes)))        # next virtual node that may have room, by path halving
    for cell, k, lo in left:
        while lo < counts[cell]:
            while room[nodes[k][1]] == 0:
                if onward[k] == k:
                    onward[k] = (k + 1) % len(nodes)
                onward[k], k = (onward[onward[k]] if onward[onward[k]] != k else onward[k]), onward[k]
            lo = put(cell, lo, counts[cell], nodes[k][1])
    return pd.DataFrame(out, columns=["cell", "lo", "hi", "shard", "base"]).astype("int64")


def assign_shards(docs: DataFrame, shards: int = 16, vnodes: int = 64, load_factor: float = 1.0,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size (bytes + 1), text_crc32, shard, slot (gapless in a shard)."""
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    pos = F.xxhash64(F.col(id_col))
    rows = stage(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), pos.alias("pos"),
        F.shiftrightunsigned(pos, 64 - CELL_BITS).cast("int").alias("cell")), "shard-rows")
    counts = {r["cell"]: r["n"] for r in rows.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    ranges = lay_out(counts, shards, vnodes, load_factor)
    plan = spark.createDataFrame(ranges, "cell long, lo long, hi long, shard long, base long")
    # A cell's rank is a two-level running count: a cell that holds one id's many rows is split like any other.
    ranked = chunked_running_sum(rows, ["cell"], [F.col(c) for c in ("pos", "doc_id", "text_crc32", "size")],
                                 {"rank": F.lit(1).cast("long")}, inclusive=False)
    return (ranked
            .join(F.broadcast(plan.withColumn("cell", F.col("cell").cast("int"))), "cell")
            .filter((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
            .select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                    (F.col("base") + F.col("rank") - F.col("lo")).cast("long").alias("slot")))
