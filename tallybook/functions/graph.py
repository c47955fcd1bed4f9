"""Connected components of a link table (label propagation with hooking and shortcuts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.session import stage, unstage


def account_components(edges: DataFrame) -> DataFrame:
    """edges (a, b) of long node numbers → (node, component), the smallest node each node reaches.

    Every node points at a parent, itself at first. A round looks, for each node, at the smallest grandparent
    among its neighbours and lets the node, and its parent, point there if that is smaller; then every node
    takes a shortcut to its grandparent. Trees merge and flatten together, so a chain of n nodes needs
    a number of rounds logarithmic in n. A round is equi-joins and minimum aggregates (combined before the
    shuffle, so a node with very many links is harmless) and one written table of two numbers per node.
    """
    both = edges.filter("a <> b").select("a", "b").unionByName(edges.filter("a <> b").select(
        F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stage(both, "graph-edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    at = stage(nodes.select("node", F.col("node").alias("parent"), F.col("node").alias("grand")), "graph-parents")
    while True:
        near = (both.join(at.select(F.col("node").alias("b"), "grand"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("grand").alias("low")))
        seen = at.join(near, "node", "left").withColumn("low", F.least("low", "grand", "parent"))
        offers = (seen.select("node", F.col("low").alias("parent"))
                  .unionByName(seen.select(F.col("parent").alias("node"), F.col("low").alias("parent"))))
        parent = stage(offers.groupBy("node").agg(F.min("parent").alias("parent")), "graph-hooks")
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        new = stage(parent.join(up, "parent").select("node", "parent", "grand"), "graph-parents")
        moved = (new.join(at.select("node", F.col("parent").alias("p0"), F.col("grand").alias("g0")), "node")
                 .filter("parent <> p0 or grand <> g0"))
        done = moved.isEmpty()
        unstage(parent)
        unstage(at)
        at = new
        if done:
            break
    unstage(both)
    return at.select("node", F.col("parent").alias("component"))
