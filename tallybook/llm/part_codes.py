"""Vector codes by product quantisation, its k-means run over anchors-hierarchy metric trees.

Vectors become integers (``floor(scale * x)``) and are cut into equal parts; every part position has a codebook
of its own. Vectors stay where they are read, in blocks of at most ``BLOCK`` rows. For each block and part
position one metric tree is grown once, middle-out: about sqrt(n) anchors are picked, each the point farthest
from its nearest anchor so far, and take over points from their neighbours (a point nearer to its anchor than
half the distance of the two anchors cannot move and is not looked at); each anchor's points are split the
same way; then anchors are joined upwards, two balls of least joint radius at a time. Every ball caches its
centre, radius, count and sum, and its points lie side by side.

A round of k-means walks all trees with the current codebook, level by level. A ball inherits its parent's list of
candidate entries and drops those that cannot be nearest for any point of it (the bisecting plane between an
entry and the one nearest to the ball's centre lies beyond the ball). A ball with one entry left is wholly
owned: its cached count and sum go to the entry and its points are never looked at. What is left at the leaves
is compared point by point, in integers. Only sums per (part, entry, component) leave the tasks; the driver sees
the codebooks alone, whose size does not depend on the data.

Rules: rows whose vector is null or has null or non-finite components are dropped, as are vectors of another
length than that of the smallest kept id; entries start as the parts of the smallest kept ids (repeated ids in
order of their vectors; a null id comes last), fewer if there are fewer rows; equal entries: the lower index owns;
an entry without points stays. The length must be a multiple of the number of parts, and scaled components lie
within ±2**26, so that all arithmetic is exact in 64 bits. An empty table gives no rows. Repeated rows are
coded each. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import small_batches
from tallybook.session import stage

BLOCK = 4096         # rows whose parts share one tree
LEAF = 32            # points of a ball that is not split further
_BATCH = "16m"       # Arrow batch of blocks
TREE = "struct<order:binary,points:binary,balls:binary,sums:binary,radii:binary>"
_TREE = pa.struct([(n, pa.binary()) for n in ("order", "points", "balls", "sums", "radii")])


class Tree:
    """A metric tree over integer points: points in ball order and, per ball, (low, high, left, right),
    sum of its points and radius about their mean. Leaves have no children (-1)."""

    def __init__(self, order, points, balls, sums, radii):
        self.order, self.points, self.balls, self.sums, self.radii = order, points, balls, sums, radii
        self.counts = balls[:, 1] - balls[:, 0]
        self.centres = sums / np.maximum(self.counts, 1)[:, None]

    def pack(self) -> dict[str, bytes]:
        return {"order": self.order.astype("<i4").tobytes(), "points": self.points.astype("<i4").tobytes(),
                "balls": self.balls.astype("<i4").tobytes(), "sums": self.sums.astype("<i8").tobytes(),
                "radii": self.radii.astype("<f8").tobytes()}

    @classmethod
    def unpack(cls, d: dict[str, bytes], width: int) -> Tree:
        return cls(np.frombuffer(d["order"], "<i4"), np.frombuffer(d["points"], "<i4").reshape(-1, width).astype(np.int64),
                   np.frombuffer(d["balls"], "<i4").reshape(-1, 4), np.frombuffer(d["sums"], "<i8").reshape(-1, width),
                   np.frombuffer(d["radii"], "<f8"))


def anchors(points: np.ndarray, most: int) -> list[np.ndarray]:
    """Indices of the points owned by each of at most ``most`` anchors."""
    dist = np.sqrt(((points - points[0]) ** 2).sum(axis=1, dtype=np.float64))
    owner = np.zeros(len(points), np.int64)
    at = [0]
    while len(at) < most:
        new = int(dist.argmax())
        if dist[new] == 0:
            break
        between = np.sqrt(((points[at] - points[new]) ** 2).sum(axis=1, dtype=np.float64))
        near = np.flatnonzero(dist > between[owner] / 2)
        d = np.sqrt(((points[near] - points[new]) ** 2).sum(axis=1, dtype=np.float64))
        moves = near[d < dist[near]]
        owner[moves] = len(at)
        dist[moves] = d[d < dist[near]]
        at.append(new)
    return [own for k in range(len(at)) if len(own := np.flatnonzero(owner == k))]


def _join(nodes: list) -> tuple:
    """Balls (centre, radius, count, node) joined two at a time, always those of least joint radius."""
    n = len(nodes)
    centre = np.array([b[0] for b in nodes])
    radius = np.array([b[1] for b in nodes])
    apart = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(axis=2))
    cost = np.maximum((apart + radius[:, None] + radius[None]) / 2, np.maximum(radius[:, None], radius[None]))
    np.fill_diagonal(cost, np.inf)
    nodes = list(nodes)
    for _ in range(n - 1):
        i, j = divmod(int(cost.argmin()), n)
        (ci, ri, ni, a), (cj, rj, nj, b) = nodes[i], nodes[j]
        c = (ci * ni + cj * nj) / (ni + nj)
        r = max(np.linalg.norm(c - ci) + ri, np.linalg.norm(c - cj) + rj)
        nodes[i], nodes[j] = (c, r, ni + nj, (a, b)), None
        centre[i], radius[i] = c, r
        cost[j, :] = cost[:, j] = np.inf
        alive = np.isfinite(cost[i])
        row = np.sqrt(((centre - c) ** 2).sum(axis=1))
        row = np.maximum((row + radius + r) / 2, np.maximum(radius, r))
        cost[i, alive] = cost[alive, i] = row[alive]
    return next(b for b in nodes if b is not None)


def grow(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """The anchors hierarchy of integer points."""
    points = points.astype(np.int64)

    def node(idx: np.ndarray) -> tuple:
        own = points[idx]
        centre = own.mean(axis=0)
        if len(idx) > leaf:
            groups = anchors(own, max(2, int(np.sqrt(len(idx)))))
            if len(groups) > 1:
                return _join([node(idx[g]) for g in groups])
        return centre, float(np.sqrt(((own - centre) ** 2).sum(axis=1).max())), len(idx), idx

    balls, order, at = [], [], 0
    todo = [(node(np.arange(len(points)))[3], -1, 0)] if len(points) else []
    while todo:                                      # depth first, so that a ball's points lie side by side
        what, parent, side = todo.pop()
        if isinstance(what, int):                    # both children of ball ``what`` are laid out
            balls[what][1] = at
            continue
        if parent >= 0:
            balls[parent][side] = len(balls)
        me = len(balls)
        balls.append([at, at, -1, -1])
        if isinstance(what, tuple):
            todo += [(me, -1, 0), (what[1], me, 3), (what[0], me, 2)]
        else:
            order.append(what)
            at += len(what)
            balls[me][1] = at
    order = np.concatenate(order) if order else np.zeros(0, np.int64)
    placed = points[order]
    balls = np.array(balls, np.int64).reshape(-1, 4)
    running = np.concatenate([np.zeros((1, points.shape[1]), np.int64), placed.cumsum(axis=0)])
    sums = running[balls[:, 1]] - running[balls[:, 0]]
    radii = np.zeros(len(balls))
    for k, (lo, hi, _, _) in enumerate(balls):
        radii[k] = np.sqrt(((placed[lo:hi] - sums[k] / (hi - lo)) ** 2).sum(axis=1).max())
    return Tree(order, placed, balls, sums, radii)


def walk(tree: Tree, book: np.ndarray):
    """Yield what each entry owns: ("balls", indices, entries), then ("points", positions, entries).

    ``book``: (entries, width) integers. Positions count in the tree's own order of points.
    """
    if not len(tree.balls) or not len(book):
        return
    gaps = np.sqrt(((book[:, None] - book[None]) ** 2).sum(axis=2, dtype=np.float64))
    first = np.array([not (gaps[k, :k] == 0).any() for k in range(len(book))])   # equal entries: the lower owns
    at, lists, leaves = np.zeros(1, np.int64), first[None, :], []
    while len(at):
        d2 = ((tree.centres[at][:, None] - book[None]) ** 2).sum(axis=2)
        d2 = np.where(lists, d2, np.inf)
        best = d2.argmin(axis=1)
        low = d2[np.arange(len(at)), best][:, None]
        reach = tree.radii[at][:, None] * (1 + 1e-9) + 1e-6
        with np.errstate(invalid="ignore", divide="ignore"):
            beyond = (d2 - low) / (2 * gaps[best]) > reach
        lists = lists & ~beyond
        lists[np.arange(len(at)), best] = True
        whole = lists.sum(axis=1) == 1
        if whole.any():
            yield "balls", at[whole], best[whole]
        at, lists = at[~whole], lists[~whole]
        leaf = tree.balls[at, 2] < 0
        leaves += [(b, m) for b, m in zip(at[leaf], lists[leaf], strict=True)]
        inner, handed = at[~leaf], lists[~leaf]
        at = np.concatenate([tree.balls[inner, 2], tree.balls[inner, 3]]).astype(np.int64)
        lists = np.concatenate([handed, handed])
    if leaves:
        spans = [np.arange(tree.balls[b, 0], tree.balls[b, 1]) for b, _ in leaves]
        pos = np.concatenate(spans)
        allowed = np.repeat(np.array([m for _, m in leaves]), [len(s) for s in spans], axis=0)
        d2 = ((tree.points[pos][:, None] - book[None]) ** 2).sum(axis=2)
        yield "points", pos, np.where(allowed, d2, np.iinfo(np.int64).max).argmin(axis=1)


def gather(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums (entries, width) and counts (entries) of the points each entry owns."""
    sums, counts = np.zeros(book.shape, np.int64), np.zeros(len(book), np.int64)
    for kind, which, entry in walk(tree, book):
        np.add.at(sums, entry, tree.sums[which] if kind == "balls" else tree.points[which])
        np.add.at(counts, entry, tree.counts[which] if kind == "balls" else 1)
    return sums, counts


def assign(tree: Tree, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every point, in the order the points were given."""
    entry = np.zeros(len(tree.order), np.int64)
    for kind, which, owned in walk(tree, book):
        if kind == "points":
            entry[which] = owned
        else:
            for b, e in zip(which, owned, strict=True):
                entry[tree.balls[b, 0]:tree.balls[b, 1]] = e
    error = ((tree.points - book[entry]) ** 2).sum(axis=1) if len(entry) else np.zeros(0, np.int64)
    back = np.empty(len(entry), np.int64)
    back[tree.order] = np.arange(len(entry))
    return entry[back], error[back]


def usable(vector: Column) -> Column:
    """Not null and all components finite."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                                         & (F.abs(x) < F.lit(float("inf"))))


def _scaled(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def _blocks(kept: DataFrame, parts: int, block: int) -> DataFrame:
    """(ids, labels, trees): one row per block, one tree per part position."""
    from pyspark.sql.pandas.types import to_arrow_type
    id_type, label_type = (to_arrow_type(kept.schema[c].dataType) for c in ("vec_id", "label"))

    def rows(ids: list, labels: list, vectors: list) -> pa.RecordBatch:
        x = np.stack(vectors)
        if len(x) and np.abs(x).max() > 2 ** 26:
            raise ValueError("scaled components must lie within ±2**26")
        trees = [grow(p).pack() for p in np.split(x, parts, axis=1)]
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(id_type)), pa.array([labels], pa.list_(label_type)),
             pa.array([trees], pa.list_(_TREE))], names=["ids", "labels", "trees"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = [], [], []
        for batch in batches:
            for i, l, v in zip(*(batch.column(k) for k in range(3)), strict=True):
                ids.append(i.as_py())
                labels.append(l.as_py())
                vectors.append(v.values.to_numpy())
                if len(ids) == block:
                    yield rows(ids, labels, vectors)
                    ids, labels, vectors = [], [], []
        if ids:
            yield rows(ids, labels, vectors)

    kinds = [kept.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    return kept.select("vec_id", "label", "parts").mapInArrow(
        make, f"ids array<{kinds[0]}>, labels array<{kinds[1]}>, trees array<{TREE}>")


def train(blocks: DataFrame, books: list[np.ndarray], rounds: int) -> list[np.ndarray]:
    """Codebooks after ``rounds`` rounds: each entry becomes its parts' floored mean."""
    for _ in range(rounds):
        def total(batches: Iterator[pa.RecordBatch], books=books) -> Iterator[pa.RecordBatch]:
            sums = [np.zeros(b.shape, np.int64) for b in books]
            counts = [np.zeros(len(b), np.int64) for b in books]
            for batch in batches:
                for row in batch.column("trees"):
                    for p, packed in enumerate(row.as_py()):
                        s, c = gather(Tree.unpack(packed, books[p].shape[1]), books[p])
                        sums[p] += s
                        counts[p] += c
            out = [(p, e, k, int(sums[p][e, k]), int(counts[p][e])) for p in range(len(books))
                   for e in np.flatnonzero(counts[p]) for k in range(books[p].shape[1])]
            cols = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             names=["part", "entry", "at", "total", "n"])
        with small_batches(blocks.sparkSession, _BATCH):
            got = (blocks.select("trees").mapInArrow(total, "part long, entry long, at long, total long, n long")
                   .groupBy("part", "entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect())
        books = [b.copy() for b in books]
        for r in got:
            books[r.part][r.entry, r.at] = r.total // r.n
    return books


def encode(blocks: DataFrame, books: list[np.ndarray], id_kind, label_kind) -> DataFrame:
    """(vec_id, label, code, error) of every row."""
    from pyspark.sql.pandas.types import to_arrow_type
    id_type, label_type = to_arrow_type(id_kind), to_arrow_type(label_kind)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                both = [assign(Tree.unpack(t, b.shape[1]), b) for t, b in zip(row["trees"], books, strict=True)]
                codes = np.stack([e for e, _ in both], axis=1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], id_type), pa.array(row["labels"], label_type),
                     pa.array([c.tobytes().hex() for c in codes], pa.string()),
                     pa.array(sum(d for _, d in both), pa.int64())], names=["vec_id", "label", "code", "error"])
    return blocks.mapInArrow(write, f"vec_id {id_kind.simpleString()}, label {label_kind.simpleString()}, "
                                    "code string, error long")


def books_digest(books: list[np.ndarray]) -> str:
    said = ",".join(str(x) for b in books for x in b.ravel().tolist())
    return hashlib.sha256(said.encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
             block: int = BLOCK) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) of every usable row of (vec_id, embedding, label), and the codebooks."""
    if entries > 256:
        raise ValueError("a code has one byte per part: at most 256 entries")
    v = F.col("embedding")
    kept = vectors.filter(usable(v)).select("vec_id", "label", _scaled(v, scale).alias("parts"))
    order = [F.col("vec_id").asc_nulls_last(), F.col("parts")]
    seeds = [r.parts for r in kept.orderBy(*order).limit(entries).collect()]
    width = len(seeds[0]) if seeds else parts
    if not width or width % parts:
        raise ValueError(f"vectors of length {width} cannot be cut into {parts} equal parts")
    kept = kept.filter(F.size("parts") == width)
    if any(len(s) != width for s in seeds):
        seeds = [r.parts for r in kept.orderBy(*order).limit(entries).collect()]
    books = np.split(np.array(seeds, np.int64).reshape(-1, width), parts, axis=1)
    with small_batches(vectors.sparkSession, _BATCH):
        blocks = stage(_blocks(kept, parts, block), "part-trees")
        books = train(blocks, books, rounds)
        kinds = [vectors.schema[c].dataType for c in ("vec_id", "label")]
        return stage(encode(blocks, books, *kinds), "part-codes"), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error: the error summed over equal labels, null labels together."""
    total = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    return (codes.alias("c").join(total.alias("t"), F.col("c.label").eqNullSafe(F.col("t.label")))
            .select("c.*", "label_error"))
