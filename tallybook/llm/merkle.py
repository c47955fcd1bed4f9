"""Merkle manifest of a dataset, proved by octopus multiproofs.

Leaves are digests of rows, ascending by id within their language. A language's nodes are hashed two at a
time (an odd last one alone) until one is left, its subroot; the subroots, ordered by language, are hashed
alike to the root. Every hash is SHA-256 in lowercase hex over the concatenated hex of its inputs.

Building. A row's position comes from a two-level running count, so no language is sorted in one task.
Trees are folded ``2**BITS`` neighbours at a time: a group of at most that many nodes becomes one node
``BITS`` levels up, and a round over what remains follows while a tree is not down to one node.

Proving. Rows are cut into leaf partitions of ``run`` neighbours of the whole order, wherever the trees'
own borders lie. A partition needs, of every tree and level, only the nodes beside its own range: at most one
to its left and one to its right. It states these coordinates once (two per level, not one per leaf and
level), gets them with one join, derives every interior node its leaves share, and expands each leaf's own
proof from that, in a task that sees ``run`` leaves. Building keeps only nodes that some partition states.

Rules: a null column is ``-`` in the leaf; a null language is a language of its own and comes first; null ids
come first, rows with one id follow each other by leaf digest; a single leaf is its own subroot, a single subroot
the root; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.windows import chunked_running_sum
from tallybook.session import stage, unstage

BITS = 10            # levels folded by one group of a round
RUN = 2048           # leaves of a partition that shares one multiproof
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = -1             # number of the tree over the subroots


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def leaf_digest(fields: dict[str, Column]) -> Column:
    """H of the fields, each ``-`` if null, else its UTF-8 length, ``:`` and its value."""
    said = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")),
                       F.lit("-")) for c in fields.values()]
    return F.sha2(F.concat(*said), 256)


def height(n: Column) -> Column:
    """Levels above the leaves of a tree with ``n`` leaves: the bits of n - 1."""
    return F.when(n <= 1, F.lit(0)).otherwise(F.length(F.bin(n - 1)))


def fold(first: int, digests: list[str], level: int, top: int, n: int):
    """Yield (level, first index, digests) of every level above ``level`` up to ``top``.

    ``digests`` are the nodes from index ``first`` (even) on; ``n`` is the tree's number of leaves.
    """
    while level < top:
        digests = [sha("".join(digests[k:k + 2])) for k in range(0, len(digests), 2)]
        first, level = first >> 1, level + 1
        yield level, first, digests


def _levels(n: int) -> int:
    return max(int(n) - 1, 0).bit_length()


def _stated(level: int, idx: np.ndarray, offset: int, run: int, n: int) -> np.ndarray:
    """Which nodes of a level lie beside a border of leaf partitions.

    Borders are the positions x with (x + offset) divisible by ``run``, 0 < x < n. The partition right of
    x may state node (x >> level) - 1, the one left of it ((x - 1) >> level) + 1.
    """
    def borders(lo, hi):                            # how many x in lo .. hi - 1
        lo, hi = np.maximum(lo, 1), np.minimum(hi, n)
        return np.where(hi > lo, (hi - 1 + offset) // run - (lo - 1 + offset) // run, 0)
    wide = 1 << level
    return (borders((idx + 1) * wide, (idx + 2) * wide) + borders((idx - 1) * wide + 1, idx * wide + 1)) > 0


def _fold_round(nodes: DataFrame, level: int, run: int) -> DataFrame:
    """One round: nodes of ``level`` (tree, n, begin, idx, digest) → stated nodes and the ones that go up.

    ``begin`` is the place of the tree's first leaf in the whole order; all nodes of the top tree are kept.
    """
    def up(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.sort_by("idx")
        tree, n, begin = key[0].as_py(), group["n"][0].as_py(), group["begin"][0].as_py()
        first, digests = group["idx"][0].as_py(), group["digest"].to_pylist()
        out = {"level": [], "idx": [], "digest": [], "kept": []}

        def put(at: int, first: int, digests: list[str]):
            idx = np.arange(first, first + len(digests))
            kept = np.full(len(idx), True) if tree == TOP else _stated(at, idx, begin, run, n)
            for k in np.flatnonzero(kept | (at == top)):
                out["level"].append(at)
                out["idx"].append(int(idx[k]))
                out["digest"].append(digests[k])
                out["kept"].append(bool(kept[k]))
        top = min(level + BITS, _levels(n))
        if level == 0:                              # later rounds' own level is known from the round before
            put(level, first, digests)
        for at, start, folded in fold(first, digests, level, top, n):
            put(at, start, folded)
        rows = len(out["level"])
        return pa.table({"tree": pa.array([tree] * rows, pa.int64()), "n": pa.array([n] * rows, pa.int64()),
                         "begin": pa.array([begin] * rows, pa.int64()), "level": pa.array(out["level"], pa.int32()),
                         "idx": pa.array(out["idx"], pa.int64()), "digest": pa.array(out["digest"], pa.string()),
                         "kept": pa.array(out["kept"], pa.bool_())})
    return (nodes.withColumn("block", F.shiftright("idx", BITS)).groupBy("tree", "block")
            .applyInArrow(up, "tree long, n long, begin long, level int, idx long, digest string, kept boolean"))


def build(leaves: DataFrame, run: int) -> tuple[DataFrame, DataFrame]:
    """Leaves (tree, n, begin, idx, digest) → nodes (tree, level, idx, digest) and roots (tree, digest)."""
    level, going, parts, roots = 0, leaves, [], []
    while True:
        made = stage(_fold_round(going, level, run), "merkle-nodes")
        parts.append(made.filter("kept").select("tree", "level", "idx", "digest"))
        ends = F.least(height(F.col("n")), F.lit(level + BITS))
        risen = made.filter(F.col("level") == ends)
        roots.append(risen.filter(ends == height(F.col("n"))).select("tree", "digest"))
        going = risen.filter(height(F.col("n")) > level + BITS).select("tree", "n", "begin", "idx", "digest")
        level += BITS
        if going.isEmpty():
            break
    nodes, tops = parts[0], roots[0]
    for p, r in zip(parts[1:], roots[1:], strict=True):
        nodes, tops = nodes.unionByName(p), tops.unionByName(r)
    return nodes, tops


def _beside(spans: DataFrame) -> DataFrame:
    """Missing node coordinates of spans (part, tree, n, lo, hi): the siblings outside on each level."""
    at = F.explode(F.sequence(F.lit(0), height(F.col("n")) - 1)).alias("level")
    levels = spans.filter("n > 1").select("*", at).select(
        "part", "tree", "level", F.expr("shiftright(lo, level)").alias("a"),
        F.expr("shiftright(hi, level)").alias("b"), F.expr("shiftright(n - 1, level)").alias("last"))
    left = levels.filter("a % 2 = 1").select("part", "tree", "level", (F.col("a") - 1).alias("idx"))
    right = levels.filter("b % 2 = 0 and b < last").select("part", "tree", "level", (F.col("b") + 1).alias("idx"))
    return left.unionByName(right)


class Octopus:
    """The nodes one leaf partition knows of a tree: its own span on every level and the fetched ones beside it."""

    def __init__(self, n: int, lo: int, digests: list[str], fetched: dict[tuple[int, int], str]):
        self.n, self.top = n, _levels(n)
        self.known = [dict(enumerate(digests, lo))]
        for level in range(self.top):
            own = self.known[level]
            low, high = min(own), max(own)
            for idx in (low - 1, high + 1):
                if (level, idx) in fetched:
                    own[idx] = fetched[level, idx]
            last = (n - 1) >> level
            up = {}
            for p in range(low >> 1, (high >> 1) + 1):
                pair = own[2 * p] + (own[2 * p + 1] if 2 * p < last else "")
                up[p] = sha(pair)
            self.known.append(up)

    def siblings(self, pos: int) -> list[tuple[str, bool] | None]:
        """Per level the sibling and whether it stands left, or None where a node is alone."""
        out = []
        for level in range(self.top):
            idx = pos >> level
            if idx & 1:
                out.append((self.known[level][idx - 1], True))
            elif idx < (self.n - 1) >> level:
                out.append((self.known[level][idx + 1], False))
            else:
                out.append(None)
        return out


def refold(leaf: str, path: list[tuple[str, bool] | None]) -> str:
    """The root that a leaf and its siblings lead to."""
    for s in path:
        leaf = sha(leaf if s is None else s[0] + leaf if s[1] else leaf + s[0])
    return leaf


def _expand(kind: pa.DataType):
    """Proofs of one leaf partition from its leaves and the nodes fetched for it."""
    def expand(key: tuple[pa.Scalar, ...], leaves: pa.Table, fetched: pa.Table) -> pa.Table:
        leaves = leaves.sort_by([("tree", "ascending"), ("idx", "ascending")])
        there: dict[int, dict[tuple[int, int], str]] = defaultdict(dict)
        for t, level, i, d in zip(*(fetched[c].to_pylist() for c in ("tree", "level", "idx", "digest")), strict=True):
            there[t][level, i] = d
        col = {c: leaves[c].to_pylist() for c in ("tree", "n", "idx", "digest", "shown", "langs")}
        trees = col["tree"]
        starts = [k for k in range(len(trees)) if k == 0 or trees[k] != trees[k - 1]]
        spans = list(zip(starts, [*starts[1:], len(trees)], strict=True))
        octopi = [Octopus(col["n"][a], col["idx"][a], col["digest"][a:b], there[trees[a]]) for a, b in spans]
        subroots = [o.known[o.top][0] for o in octopi]
        if spans:
            over = Octopus(col["langs"][0], trees[0], subroots, there[TOP])
        out = {"subroot": [], "root": [], "proof_sha256": [], "folded_root": []}
        for (a, b), octopus, subroot in zip(spans, octopi, subroots, strict=True):
            upper = over.siblings(trees[a])
            root = over.known[over.top][0]
            for k in range(a, b):
                path = octopus.siblings(col["idx"][k]) + upper
                out["subroot"].append(subroot)
                out["root"].append(root)
                out["proof_sha256"].append(sha("".join([s[0] for s in path if s])))
                out["folded_root"].append(refold(col["shown"][k], path))
        made = {c: pa.array(v, pa.string()) for c, v in out.items()}
        same = [f == r for f, r in zip(out["folded_root"], out["root"], strict=True)]
        return pa.table({"doc_id": leaves["doc_id"].cast(kind), "lang": leaves["lang"], "leaf": leaves["digest"],
                         **made, "verified": pa.array(same, pa.bool_())})
    return expand


def ordered_leaves(docs: DataFrame, shown: Column | None = None) -> DataFrame:
    """Staged rows (doc_id, lang, digest, shown, place, tree, n, begin, idx, langs).

    ``shown`` is the n_chars that the verifier is shown (default: the row's own); ``place`` counts the whole order,
    ``idx`` the language's; trees are numbered in the order of languages.
    """
    own = {c: F.col(c) for c in FIELDS}
    seen = F.col("digest") if shown is None else F.when(
        shown.eqNullSafe(F.col("n_chars")), F.col("digest")).otherwise(leaf_digest(own | {"n_chars": shown}))
    rows = (docs.select(*FIELDS, F.monotonically_increasing_id().alias("row"))
            .withColumn("digest", leaf_digest(own)).withColumn("shown", seen)
            # A null language sorts before the empty one.
            .withColumn("run_key", F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")))
            .select("doc_id", "lang", "row", "digest", "shown", "run_key", F.lit(0).alias("all")))
    rows = stage(rows, "merkle-digests")               # texts are read once; what follows moves digests only
    order = [F.col("run_key"), F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("row")]
    placed = stage(chunked_running_sum(rows, ["all"], order, {"place": F.lit(1).cast("long")}, inclusive=False)
                   .drop("all", "row"), "merkle-leaves")
    unstage(rows)
    langs = placed.groupBy("run_key").agg(F.count("*").alias("n"), F.min("place").alias("begin"))
    numbered = stage(chunked_running_sum(langs.withColumn("all", F.lit(0)), ["all"], [F.col("run_key")],
                                         {"tree": F.lit(1).cast("long")}, inclusive=False).drop("all"),
                     "merkle-languages")
    many = numbered.count()
    return (placed.join(numbered, "run_key").drop("run_key").withColumn("idx", F.col("place") - F.col("begin"))
            .withColumn("langs", F.lit(many).cast("long")))


def manifest(docs: DataFrame, shown: Column | None = None, run: int = RUN) -> DataFrame:
    """One row per row: doc_id, lang, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``folded_root`` is recomputed from the leaf with n_chars ``shown`` and the siblings of the original.
    """
    leaves = ordered_leaves(docs, shown)
    nodes, subroots = build(leaves.select("tree", "n", "begin", "idx", "digest"), run)
    count = leaves.select("tree", "langs").distinct()
    over = (subroots.join(count, "tree").select(F.lit(TOP).cast("long").alias("tree"), F.col("langs").alias("n"),
                                                F.lit(0).cast("long").alias("begin"), F.col("tree").alias("idx"),
                                                "digest"))
    over_nodes, _ = build(over, run)
    mine = leaves.withColumn("part", F.floor(F.col("place") / run))
    spans = (mine.groupBy("part", "tree", "n").agg(F.min("idx").alias("lo"), F.max("idx").alias("hi")))
    high = (mine.groupBy("part", F.col("langs").alias("n")).agg(F.min("tree").alias("lo"), F.max("tree").alias("hi"))
            .withColumn("tree", F.lit(TOP).cast("long")))
    stated = _beside(spans).unionByName(_beside(high.select("part", "tree", "n", "lo", "hi")))
    fetched = stage(stated.join(nodes.unionByName(over_nodes), ["tree", "level", "idx"])
                    .select("part", "tree", "level", "idx", "digest"), "merkle-fetched")
    from pyspark.sql.pandas.types import to_arrow_type
    kind = docs.schema["doc_id"].dataType
    schema = (f"doc_id {kind.simpleString()}, lang {docs.schema['lang'].dataType.simpleString()}, leaf string, "
              "subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return (mine.select("part", "doc_id", "lang", "tree", "n", "idx", "digest", "shown", "langs").groupBy("part")
            .cogroup(fetched.groupBy("part")).applyInArrow(_expand(to_arrow_type(kind)), schema))
