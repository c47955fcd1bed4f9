"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.session import stage, unstage


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """links (src, dst) → (node, component): the smallest node each node reaches, nodes with links only.

    Every step rewires each node's neighbours to its smallest neighbour and removes duplicates, so
    edges never multiply; a step's minimum is a partial aggregate and its joins are equi-joins, so a node
    with very many links is split like any skewed key. Rounds run until nothing changes (their number is
    logarithmic in the longest path); each is a written table in the shared folder.
    """
    pair = links.filter(F.col("src") != F.col("dst")).select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
    edges = stage(pair, "links")
    before = _print(edges)
    while True:
        # Large star: every neighbour above a node is linked to the node's smallest neighbour.
        both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("m", "src").alias("m"))
        large = (both.filter(F.col("dst") > F.col("src")).join(low, "src")
                 .select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct())
        # Small star: a node and its smaller neighbours are linked to the smallest of them.
        low = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = (large.join(low, "src").filter(F.col("dst") != F.col("m"))
                 .select(F.col("dst").alias("src"), F.col("m").alias("dst"))
                 .unionByName(low.select("src", F.col("m").alias("dst"))).distinct())
        after = stage(small, "links")
        mark = _print(after)
        unstage(edges)
        edges = after
        if mark == before:
            break
        before = mark
    # Now every node points at its component's smallest node.
    return (edges.select(F.col("src").alias("node"), F.col("dst").alias("component"))
            .unionByName(edges.select(F.col("dst").alias("node"), F.col("dst").alias("component"))).distinct())
