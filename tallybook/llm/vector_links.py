"""Near-duplicate vectors by collision counting on many one-dimensional projections.

Equal vectors are one class first. A class's unit vector is projected on random directions; two vectors at
cosine ``limit`` differ on a direction by a normal variate of deviation s = sqrt(2 - 2 limit), unrelated ones by
one about three times as wide. Two uses of that:

* Blocks. A tree cuts ``levels`` projections at their mean. A vector belongs to the side its value is on, and to
  both if its window (half-width ``REACH * s``) crosses the cut; the sides are its cell's name. Several trees
  are used, so many that a pair at the limit shares no cell of any tree with probability 1 - ``recall`` only;
  their number and depth follow from the number and the spread of the vectors.
* Counting. Within a block vectors are sorted by the first of ``COUNTED`` projections; every vector's window of
  half-width ``WIDE * s`` in that order gives the vectors to look at, and the windows on the other
  projections are counted. Pairs with the calibrated number of collisions (a binomial quantile: a pair at the limit
  falls below it once in 10,000) are verified by their cosine in double precision.

No pair ever leaves a task: a block returns the number of links and the smallest linked class per vector. A pair
that meets in several blocks counts in one, the lowest common cell of the first common tree, which both vectors'
sides tell. A cell with more than ``BLOCK`` vectors is cut into chunks by a hash and becomes one block per two
chunks, so a group of copies spreads over many tasks of one size.

Rules: null, zero and non-finite vectors (or with a null component) link with nothing; vectors of different
length do not link; equal vectors link; a null id takes part, but is nobody's smallest id; rows with one id are
separate vectors. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.components import connected_components
from tallybook.session import stage, unstage

BLOCK = 1024         # vectors on each side of a block
COUNTED = 32         # projections whose windows are counted
WIDE = 2.0           # half-width of a counted window, in deviations of a pair at the limit
REACH = 0.25         # half-width of the window at a cut, in the same unit
DEEPEST = 30         # levels of a tree at most (sides are 32-bit masks); cells beyond are cut by chunks
MOVED = 400          # a vector moved to a block costs about as much as so many pairs
SEED = 20180413


def tail(n: int, p: float, least: int) -> float:
    """Probability of at least ``least`` of ``n`` at ``p`` each."""
    return sum(math.comb(n, k) * p ** k * (1 - p) ** (n - k) for k in range(least, n + 1))


def calibrated_count(counted: int, wide: float, recall: float = 0.9999) -> int:
    """The largest number of collisions that a pair at the limit reaches with probability ``recall``."""
    p = math.erf(wide / math.sqrt(2))
    return max(k for k in range(counted + 1) if tail(counted, p, k) >= recall)


def plan(n: int, spread: float, s: float, recall: float) -> tuple[int, int]:
    """(levels, trees) of least estimated work for ``n`` vectors whose projections deviate by ``spread``."""
    if n <= BLOCK or spread <= 0:
        return 0, 1
    c = 2 * REACH
    beyond = 2 * s * (math.exp(-c * c / 2) / math.sqrt(2 * math.pi) - c * (1 - math.erf(c / math.sqrt(2))) / 2)
    stays = max(1 - beyond / (spread * math.sqrt(2 * math.pi)), 0.0)    # a pair is not parted by one cut
    copies = 1 + math.erf(REACH * s / (spread * math.sqrt(2)))
    best = (math.inf, 0, 1)
    for levels in range(DEEPEST + 1):
        together = stays ** levels
        trees = 1 if together >= recall else math.ceil(math.log(1 - recall) / math.log(1 - together)) if together > 0 else 10 ** 6
        rows = n * copies ** levels
        work = trees * (rows * rows / 2 ** levels / 2 + MOVED * rows)
        best = min(best, (work, levels, trees))
    return best[1], best[2]


def directions(width: int, n: int, kind: int) -> np.ndarray:
    return np.random.default_rng([SEED, kind, width]).standard_normal((width, n))


def _read(vectors: DataFrame) -> DataFrame:
    """(vec_id, key, width, unit): ``key`` names equal vectors, null if a vector cannot link."""
    from pyspark.sql.pandas.types import to_arrow_type
    kind = vectors.schema["vec_id"].dataType
    id_type = to_arrow_type(kind)
    double = "double" in vectors.schema["embedding"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, widths, units = [], [], []
            for v in batch.column(1):
                x = np.zeros(0) if not v.is_valid else v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not len(x) or not np.isfinite(x).all() or not x.any():
                    keys.append(None)
                    widths.append(None)
                    units.append(None)
                    continue
                x = x + 0.0                          # minus zero is zero
                keys.append(hashlib.sha256(x.tobytes()).digest())
                widths.append(len(x))
                units.append(x.astype("<f8" if double else "<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(id_type), pa.array(keys, pa.binary()),
                                              pa.array(widths, pa.int32()), pa.array(units, pa.binary())],
                                             names=["vec_id", "key", "width", "vector"])
    return vectors.select("vec_id", "embedding").mapInArrow(
        make, f"vec_id {kind.simpleString()}, key binary, width int, vector binary")


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Unit vectors in double precision."""
    raw = b"".join(column.to_pylist())
    x = np.frombuffer(raw, "<f8" if len(raw) == 8 * width * len(column) else "<f4").reshape(-1, width).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _means(classes: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """Per vector length the number of classes and the mean unit vector."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            widths = batch.column(0).to_numpy()
            for w in np.unique(widths):
                x = _matrix(pa.chunked_array([batch.column(1).filter(pa.array(widths == w))]), int(w))
                got = total.setdefault(int(w), [0, np.zeros(int(w))])
                got[0] += len(x)
                got[1] += x.sum(axis=0)
        out = [(w, k, n, float(t)) for w, (n, sums) in total.items() for k, t in enumerate(sums)]
        cols = list(zip(*out, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()),
                                          pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.float64())],
                                         names=["width", "at", "n", "total"])
    rows = (classes.select("width", "vector").mapInArrow(add, "width int, at int, n long, total double")
            .groupBy("width", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())
    out: dict[int, tuple[int, np.ndarray]] = {}
    for r in rows:
        out.setdefault(r.width, (r.n, np.zeros(r.width)))[1][r["at"]] = r.total / r.n
    return out


class Trees:
    """Number, depth and cuts of the trees per vector length, and where they put vectors."""

    def __init__(self, means: dict[int, tuple[int, np.ndarray]], s: float, recall: float):
        self.means, self.reach = means, REACH * s
        self.shapes = {w: plan(n, math.sqrt(max(1 - float(m @ m), 0.0)), s, recall) for w, (n, m) in means.items()}

    def place(self, vectors: pa.Array, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, tree, cell) of every copy, and (rows, trees, 2) the levels where a vector is left or right only."""
        levels, trees = self.shapes[w]
        at = _matrix(pa.chunked_array([vectors]), w) - self.means[w][1]
        value = (at @ directions(w, levels * trees, 1)).reshape(len(at), trees, levels)
        bits = (1 << np.arange(levels)).astype(np.int64)
        left = ((value < -self.reach) * bits).sum(axis=2)
        right = ((value > self.reach) * bits).sum(axis=2)
        row, tree, cell = [], [], []
        for t in range(trees):
            r, c = np.arange(len(value)), right[:, t]
            for k in range(levels):                  # a vector whose window crosses the cut is on both sides
                both = ((left[r, t] | right[r, t]) >> k & 1) == 0
                r, c = np.concatenate([r, r[both]]), np.concatenate([c, c[both] | 1 << k])
            row.append(r)
            tree.append(np.full(len(r), t))
            cell.append(c)
        return np.concatenate(row), np.concatenate(tree), np.concatenate(cell), np.stack([left, right], axis=2)


def _by_width(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    widths = batch.column("width").to_numpy()
    for w in np.unique(widths).tolist():
        yield w, batch.filter(pa.array(widths == w))


def _crowds(classes: DataFrame, trees: Trees) -> DataFrame:
    """(width, tree, cell, chunks) of the cells with more than ``BLOCK`` classes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w, own in _by_width(batch):
                _, tree, cell, _ = trees.place(own.column("vector"), w)
                key, n = np.unique(tree.astype(np.int64) << 32 | cell, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), w), pa.int32()), pa.array(key >> 32, pa.int32()),
                     pa.array(key & 0xFFFFFFFF, pa.int32()), pa.array(n, pa.int64())],
                    names=["width", "tree", "cell", "n"])
    return (classes.select("width", "vector").mapInArrow(count, "width int, tree int, cell int, n long")
            .groupBy("width", "tree", "cell").agg(F.sum("n").alias("n")).filter(F.col("n") > BLOCK)
            .select("width", "tree", "cell", F.ceil(F.col("n") / BLOCK).alias("chunks")))


def _cells(classes: DataFrame, trees: Trees) -> DataFrame:
    """One row per class, tree and cell: node, weight, width, vector, tree, cell and the sides in all trees.

    ``sides`` holds two bit masks per tree: the levels where the class is on the left only, on the right only.
    """
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w, own in _by_width(batch):
                row, tree, cell, sides = trees.place(own.column("vector"), w)
                packed = [x.tobytes() for x in sides.astype("<i4")]
                # Copies leave in slices, so that a batch with many of them is never whole in memory twice.
                for a in range(0, len(row), 20_000):
                    r = pa.array(row[a:a + 20_000])
                    yield pa.RecordBatch.from_arrays(
                        [own.column("node").take(r), own.column("weight").take(r), own.column("width").take(r),
                         own.column("vector").take(r), pa.array(tree[a:a + 20_000], pa.int32()),
                         pa.array(cell[a:a + 20_000], pa.int32()),
                         pa.array([packed[k] for k in row[a:a + 20_000]], pa.binary())],
                        names=["node", "weight", "width", "vector", "tree", "cell", "sides"])
    return (classes.select("node", "weight", "width", "vector")
            .mapInArrow(spread, "node long, weight long, width int, vector binary, tree int, cell int, sides binary"))


def collisions(a: np.ndarray, b: np.ndarray, half: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) with at least ``least`` columns no more than ``half`` apart.

    Both are sorted by their first column; a query's window there bounds what is looked at.
    """
    order_a, order_b = a[:, 0].argsort(kind="stable"), b[:, 0].argsort(kind="stable")
    a, b = a[order_a], b[order_b]
    rows, cols = [], []
    for k in range(0, len(a), 128):
        q = a[k:k + 128]
        lo, hi = np.searchsorted(b[:, 0], [q[0, 0] - half, q[-1, 0] + half], side="left")
        hi = max(int(hi), int(np.searchsorted(b[:, 0], q[-1, 0] + half, side="right")))
        seen = b[lo:hi]
        n = np.zeros((len(q), len(seen)), np.uint8)
        for j in range(a.shape[1]):
            n += np.abs(q[:, j, None] - seen[None, :, j]) <= half
        r, c = np.nonzero(n >= least)
        rows.append(order_a[r + k])
        cols.append(order_b[c + lo])
    return (np.concatenate(rows), np.concatenate(cols)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def smallest_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per node of 0 .. n - 1 the smallest node reachable by the links."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def _block(limit: float, half: float, least: int):
    """Links of one block, each counted where both classes first meet."""
    def links(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        width, tree, cell, i, j = (k.as_py() for k in key)
        group = group.sort_by("node")
        x = _matrix(group["vector"], width)
        chunk, node, weight = (group[c].to_numpy() for c in ("chunk", "node", "weight"))
        sides = np.frombuffer(b"".join(group["sides"].to_pylist()), "<i4").reshape(len(x), -1, 2)
        h = (x @ directions(width, COUNTED, 2)).astype(np.float32)
        one, two = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
        a, b = collisions(h[one], h[two], half, least)
        a, b = one[a], two[b]
        if i == j:
            a, b = a[a < b], b[a < b]
        near = np.zeros(len(a), bool)
        for k in range(0, len(a), 50_000):
            p = slice(k, k + 50_000)
            near[p] = np.einsum("ij,ij->i", x[a[p]], x[b[p]]) >= limit
        a, b = a[near], b[near]
        la, ra, lb, rb = sides[a, :, 0], sides[a, :, 1], sides[b, :, 0], sides[b, :, 1]
        met = ((la & rb) | (ra & lb)) == 0
        mine = ~met[:, :tree].any(axis=1) & ((ra[:, tree] | rb[:, tree]) == cell) if len(a) else np.zeros(0, bool)
        a, b = a[mine], b[mine]
        count = np.zeros(len(x), np.int64)
        np.add.at(count, a, weight[b])
        np.add.at(count, b, weight[a])
        low = smallest_linked(len(x), a, b)
        some = count > 0
        return pa.table({"node": pa.array(node[some], pa.int64()), "links": pa.array(count[some], pa.int64()),
                         "low": pa.array(node[low[some]], pa.int64())})
    return links


def class_links(classes: DataFrame, limit: float, recall: float) -> DataFrame:
    """Staged (node, links, low): per block and class with links, their number and the smallest class reached."""
    s = math.sqrt(2 - 2 * limit)
    means = _means(classes)
    if not means:
        return classes.sparkSession.createDataFrame([], "node long, links long, low long")
    trees = Trees(means, s, recall)
    crowd = stage(_crowds(classes, trees), "vector-crowds")
    other = F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1))
    blocks = (_cells(classes, trees).join(crowd, ["width", "tree", "cell"], "left")
              .withColumn("chunk", F.pmod(F.xxhash64("node"), F.coalesce("chunks", F.lit(1))))
              .withColumn("other", other)
              .withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other")))
    made = (blocks.select("width", "tree", "cell", "i", "j", "node", "weight", "vector", "sides", "chunk")
            .groupBy("width", "tree", "cell", "i", "j")
            .applyInArrow(_block(limit, WIDE * s, calibrated_count(COUNTED, WIDE)),
                          "node long, links long, low long"))
    out = stage(made, "vector-links")
    unstage(crowd)
    return out


def near_vectors(vectors: DataFrame, limit: float = 0.9, recall: float = 0.999) -> DataFrame:
    """One row per row of (vec_id, embedding): vec_id, n_links, component_id, kept.

    Links join vectors whose cosine is at least ``limit``; component_id is the smallest vec_id reachable by
    links, itself included; ``recall``: probability that a pair exactly at the limit shares a block.
    """
    rows = stage(_read(vectors), "vector-rows")
    classes = stage(rows.filter(F.col("key").isNotNull()).groupBy("key", "width")
                    .agg(F.min("vec_id").alias("low_id"), F.count("*").alias("weight"),
                         F.first("vector").alias("vector"))
                    .select("key", "width", "low_id", "weight", "vector",
                            F.monotonically_increasing_id().alias("node")), "vector-classes")
    found = class_links(classes, limit, recall)
    parts = connected_components(found.filter("node <> low").select(F.col("node").alias("src"),
                                                                    F.col("low").alias("dst")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (classes.select("key", "node", "low_id", "weight").join(counts, "node", "left")
             .join(parts, "node", "left").withColumn("component", F.coalesce("component", "node")))
    lowest = named.groupBy("component").agg(F.min("low_id").alias("component_id"))
    by_key = (named.join(lowest, "component")
              .select("key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    joined = rows.select("vec_id", "key").filter(F.col("key").isNotNull()).join(by_key, "key")
    alone = (rows.filter(F.col("key").isNull())
             .select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return (joined.select("vec_id", "n_links", "component_id").unionByName(alone)
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
