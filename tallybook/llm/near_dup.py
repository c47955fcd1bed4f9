"""Near-duplicate detection with SetSketch registers.

A document's set is its distinct word shingles (64-bit hashes). Register i holds
``floor(1 - log_b(min of an exponential variate over the set))``, truncated to 0 .. LAST: exponentially
spaced minima, which merge by maximum and agree with a probability close to the similarity. Equal sets
are one class first, so copies cost one row each. Of the classes, bands of ``rows`` registers are bucket
keys; buckets with the same classes are one.

Candidates of a bucket come in two steps, never all pairs. First every class meets the bucket's hub, its smallest class:
the similarity is estimated by joint maximum likelihood from both registers and both set sizes, and only when it is
out of reach of the limit (by ``slack``, four standard deviations) is the pair dropped; all others are verified on the
full sets. Most buckets are one component after that. In the others, the classes outside the bucket's
largest component meet the bucket's classes of other components, by their full sets, inside tasks that see one chunk of
each side: no pair is emitted but a link, and chunks follow the number and the size of the sets. Components of
verified links are found by alternating stars.

With 40 bands of 7 registers a pair just at similarity 0.8 shares no band once in 12,000 times, one at 0.85 once in
five million. ``tests/llm`` measures against all pairs.

Rules: words are maximal runs without ASCII white space, A-Z lower-cased; a text of fewer words than a shingle is
one shingle; texts without words (null too) have an empty set and link with nothing; a document without
id is its own component (null) and is kept; rows with one id are separate nodes, and one row of a
component is kept, the first of its smallest id. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import ROW, small_batches, with_rows, without
from tallybook.llm.components import connected_components
from tallybook.session import stage, unstage

BASE = 1.02        # spacing of the registers
RATE = 20.0        # of the exponential variates
LAST = 2 ** 12     # registers are 0 .. LAST; the largest sets of 10**30 shingles stay below
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX32 = np.uint32(0x85EBCA6B)
_PIECE = 1 << 15   # shingles whose variates are worked out together
_CHUNK = 400_000   # shingles handled at once
_SETS = 2_000      # and sets
_BATCH = "8m"      # Arrow batch of texts; the workers stay small beside the joins' memory
CHUNK_SETS = 1024          # classes of a bucket that one side of a task holds, and about so many shingles of theirs
CHUNK_ITEMS = 1_000_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, size: int, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = _mixed(out * _MIX + h[k:len(h) - size + 1 + k])
    return np.unique(out)


def _fingerprint(items: np.ndarray) -> bytes | None:
    """128-bit fingerprint of a set, None if it is empty."""
    return xxhash.xxh3_128_digest(items.astype("<u8").tobytes()) if len(items) else None


def registers(sets: list[np.ndarray], m: int) -> np.ndarray:
    """(sets, m) SetSketch registers; an empty set's are 0.

    Each register's variates come from a 32-bit mix of the shingles' two halves, worked out for pieces of
    whole sets that stay in the processor's cache.
    """
    out = np.zeros((len(sets), m), np.uint16)
    full = [k for k, s in enumerate(sets) if len(s)]
    if not full:
        return out
    every = np.concatenate([sets[k] for k in full])
    low_half, high_half = every.astype(np.uint32), (every >> np.uint64(32)).astype(np.uint32)
    ends = np.cumsum([len(sets[k]) for k in full])
    first = np.concatenate([[0], ends[:-1]])
    seeds = np.random.default_rng(20210101).integers(1, 2 ** 32, (2, m), np.uint32) | np.uint32(1)
    least = np.empty((m, len(full)), np.uint32)
    a = 0
    while a < len(full):
        b = max(a + 1, int(np.searchsorted(ends, first[a] + _PIECE, side="right")))
        own, at = slice(first[a], ends[b - 1]), first[a:b] - first[a]
        one, two = low_half[own], high_half[own]
        v, t = np.empty_like(one), np.empty_like(one)
        for i in range(m):
            np.multiply(one, seeds[0, i], out=v)
            np.multiply(two, seeds[1, i], out=t)
            v += t
            np.right_shift(v, np.uint32(15), out=t)
            v ^= t
            v *= _MIX32
            least[i, a:b] = np.minimum.reduceat(v, at)
        a = b
    x = -np.log1p(-(least.T + 0.5) / 2.0 ** 32) / RATE          # smallest variate of each register
    out[full] = np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, LAST)
    return out


def likely_similarity(less: np.ndarray, more: np.ndarray, m: int, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood similarity from the registers where A is below or above B and both sizes."""
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    grid = np.linspace(0, 1, 101)[None, :]
    j = np.minimum(grid, np.minimum(u / v, v / u))

    def p(x: np.ndarray) -> np.ndarray:
        return np.maximum(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE), 1e-12)
    above, below = p(u - v * j), p(v - u * j)
    equal = np.maximum(1 - above - below, 1e-12)
    d_above, d_below = more[:, None], less[:, None]
    log = d_above * np.log(above) + d_below * np.log(below) + (m - d_above - d_below) * np.log(equal)
    return np.take_along_axis(j, log.argmax(axis=1)[:, None], axis=1)[:, 0]


def sketch(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """doc_id, row, text_key (hash of the text), n_shingles, set_key (fingerprint of the set, null if empty),
    registers of every row."""
    m = bands * rows

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                sets, total, start = [], 0, at
                while at < batch.num_rows and total < _CHUNK and len(sets) < _SETS:
                    s = shingle_set(batch.column(2)[at].as_py(), size, hashes)
                    sets.append(s)
                    total += len(s)
                    at += 1
                regs = registers(sets, m)
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(start, len(sets)) for c in (0, 1, 3)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_fingerprint(s) for s in sets], pa.binary()),
                    pa.array([r.astype("<u2").tobytes() for r in regs], pa.binary())], names=names)
    names = ["doc_id", "row", "text_key", "n_shingles", "set_key", "registers"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "row", "text", F.xxhash64("text").alias("text_key")).mapInArrow(
        make, f"doc_id {kind}, row long, text_key long, n_shingles long, set_key binary, registers binary")


def _estimate(m: int) -> Column:
    @F.arrow_udf("double")
    def similarity(a: pa.Array, b: pa.Array, n_a: pa.Array, n_b: pa.Array) -> pa.Array:
        if not len(a):
            return pa.array([], pa.float64())
        ra = np.frombuffer(b"".join(a.to_pylist()), "<u2").reshape(-1, m)
        rb = np.frombuffer(b"".join(b.to_pylist()), "<u2").reshape(-1, m)
        out = []
        for k in range(0, len(ra), 2000):
            s = slice(k, k + 2000)
            out.append(likely_similarity((ra[s] < rb[s]).sum(axis=1), (ra[s] > rb[s]).sum(axis=1), m,
                                         n_a.to_numpy()[s].astype(float), n_b.to_numpy()[s].astype(float)))
        return pa.array(np.concatenate(out), pa.float64())
    return similarity("reg_a", "reg_b", "n_a", "n_b")


def _small(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """A written table of a few numbers a row (under 100 bytes): broadcast up to ``rows`` rows, about 20 MB,
    joined by shuffle beyond."""
    return F.broadcast(df) if df.count() <= rows else df


def _full_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, items): the full set of every class in ``nodes``, from the text of a document of the class.

    A document is found by its id and its text's hash; the fingerprint tells whether it is the right text.
    """
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                nodes, sets, total = [], [], 0
                while at < batch.num_rows and total < _CHUNK:
                    s = shingle_set(batch.column(2)[at].as_py(), size, hashes)
                    if _fingerprint(s) == batch.column(1)[at].as_py():
                        nodes.append(batch.column(0)[at].as_py())
                        sets.append(s)
                        total += len(s)
                    at += 1
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                items = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(items))],
                    names=["node", "items"])

    wanted = stage(classes.join(nodes.select("node").distinct(), "node", "left_semi")
                   .select(F.col("rep_id").alias("doc_id"), "text_key", "node", "set_key"), "near-wanted")
    found = (docs.withColumn("text_key", F.xxhash64("text")).join(_small(wanted), ["doc_id", "text_key"])
             .select("node", "set_key", "text").mapInArrow(fetch, "node long, items array<long>"))
    with small_batches(docs.sparkSession, _BATCH):
        sets = stage(found, "near-sets")
    unstage(wanted)
    return sets


def _verified(pairs: DataFrame, classes: DataFrame, sets: DataFrame, limit: int, m: int,
              slack: float) -> DataFrame:
    """Candidate pairs (src, dst) → those whose full sets reach ``limit`` hundredths."""
    side = lambda x: classes.select(F.col("node").alias("src" if x == "a" else "dst"),
                                    F.col("n_shingles").alias(f"n_{x}"), F.col("registers").alias(f"reg_{x}"))
    near = (pairs.join(side("a"), "src").join(side("b"), "dst")
            .filter(100 * F.least("n_a", "n_b") >= limit * F.greatest("n_a", "n_b"))
            .filter(_estimate(m) >= limit / 100 - slack).select("src", "dst"))
    near = stage(near, "near-candidates")
    ends = stage(near.select(F.col("src").alias("node")).union(near.select(F.col("dst").alias("node"))).distinct(),
                 "near-ends")
    sets = sets.join(_small(ends), "node", "left_semi").dropDuplicates(["node"])
    both = (near.join(sets.select(F.col("node").alias("src"), F.col("items").alias("a")), "src")
            .join(sets.select(F.col("node").alias("dst"), F.col("items").alias("b")), "dst"))
    shared = F.size(F.array_intersect("a", "b"))
    links = stage(both.filter(100 * shared >= limit * (F.size("a") + F.size("b") - shared))
                  .select("src", "dst"), "near-links")
    unstage(near)
    unstage(ends)
    return links


def _merge(component: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components (node, component) after new links, of which only those between components count."""
    if component is None:
        return stage(connected_components(links), "near-components")
    ends = links.select(F.col("src").alias("node")).union(links.select(F.col("dst").alias("node"))).distinct()
    known = component.unionByName(ends.join(component, "node", "left_anti")
                                  .withColumn("component", F.col("node")))
    known = stage(known, "near-known")
    at = lambda x: known.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}"))
    lifted = links.join(at("src"), "src").join(at("dst"), "dst").select(
        F.col("c_src").alias("src"), F.col("c_dst").alias("dst"))
    joined = connected_components(lifted).select(F.col("node").alias("component"),
                                                 F.col("component").alias("new"))
    out = stage(known.join(joined, "component", "left").select(
        "node", F.coalesce("new", "component").alias("component")), "near-components")
    unstage(known)
    unstage(component)
    return out


def links_between(left: list[np.ndarray], right: list[np.ndarray] | None, left_component: np.ndarray,
                  right_component: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Pairs (left, right) of sets that reach ``limit`` and join components; ``right`` None: left among themselves.

    A pair of sets whose components earlier links have joined already is left out.
    """
    among = right is None
    right = left if among else right
    n_left, n_right = (np.array([len(s) for s in side]) for side in (left, right))
    names = np.unique(np.concatenate(left + ([] if among else right)))
    place = [np.searchsorted(names, s) for s in right]
    flat, starts = np.concatenate(place), np.concatenate([[0], np.cumsum(n_right)[:-1]])
    seen = np.zeros(len(names), bool)
    comp = np.concatenate([left_component, left_component if among else right_component])
    own, other = comp[:len(left)], comp[len(left):]
    out = []
    for x, items in enumerate(left):
        at = place[x] if among else np.searchsorted(names, items)
        fits = (other != own[x]) & (100 * np.minimum(n_right, n_left[x]) >= limit * np.maximum(n_right, n_left[x]))
        if among:
            fits[:x + 1] = False
        if not fits.any():
            continue
        seen[at] = True
        shared = np.add.reduceat(seen[flat], starts, dtype=np.int64)
        seen[at] = False
        for y in np.flatnonzero(fits & (100 * shared >= limit * (n_left[x] + n_right - shared))):
            if other[y] != own[x]:
                out.append((x, int(y)))
                comp[comp == other[y]] = own[x]
    return out


def _contested(active: DataFrame, component: DataFrame, classes: DataFrame, sets: DataFrame, limit: int) -> DataFrame:
    """Links (src, dst) of buckets whose classes beside the hub lie in several components, all of them examined."""
    def meet(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        node, comp, first, second = (group[c].to_numpy() for c in ("node", "component", "first", "second"))
        sets = [s.values.to_numpy() for s in group["items"]]
        one, two = np.flatnonzero(first), np.flatnonzero(second)
        among = key[1].as_py() == "others" and key[2] == key[3]
        found = []
        if len(one) and len(two):
            found = links_between([sets[k] for k in one], None if among else [sets[k] for k in two], comp[one],
                                  comp[two], limit)
        two = one if among else two
        return pa.table({"src": pa.array([node[one[a]] for a, _ in found], pa.int64()),
                         "dst": pa.array([node[two[b]] for _, b in found], pa.int64())})

    x = (active.filter(F.col("node") != F.col("hub")).select("bucket", "node").join(component, "node", "left")
         .join(classes.select("node", "n_shingles"), "node")
         .select("bucket", "node", "n_shingles", F.coalesce("component", "node").alias("component")))
    x = stage(x, "near-members")
    each = x.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("items"))
    top = F.max(F.struct("n", "items", "component"))
    per = (each.groupBy("bucket").agg(top.alias("big"), F.count("*").alias("parts"), F.sum("n").alias("n"),
                                      F.sum("items").alias("items")).filter("parts > 1"))

    def chunks(n: Column, items: Column) -> Column:
        return F.greatest(F.ceil(n / CHUNK_SETS), F.ceil(items / CHUNK_ITEMS))
    per = per.select("bucket", F.col("big.component").alias("big"),
                     chunks(F.col("n") - F.col("big.n"), F.col("items") - F.col("big.items")).alias("k_other"),
                     chunks(F.col("big.n"), F.col("big.items")).alias("k_big"))
    y = x.join(per, "bucket").withColumn("is_big", F.col("component") == F.col("big"))
    c = F.pmod(F.xxhash64("node", "bucket"), F.when(F.col("is_big"), F.col("k_big")).otherwise(F.col("k_other")))

    def meeting(kind: str, i: Column, j: Column, first: Column, second: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("i"), j.cast("long").alias("j"),
                        first.alias("first"), second.alias("second"))
    yes, no = F.lit(True), F.lit(False)
    among = F.transform(F.sequence(F.lit(0).cast("long"), F.col("k_other") - 1), lambda j: meeting(
        "others", F.least("c", j), F.greatest("c", j), F.col("c") <= j, F.col("c") >= j))
    to_big = F.transform(F.sequence(F.lit(0).cast("long"), F.col("k_big") - 1),
                         lambda j: meeting("big", F.col("c"), j, yes, no))
    from_big = F.transform(F.sequence(F.lit(0).cast("long"), F.col("k_other") - 1),
                           lambda i: meeting("big", i, F.col("c"), no, yes))
    y = (y.withColumn("c", c).select("bucket", "node", "component", F.explode(
        F.when(F.col("is_big"), from_big).otherwise(F.concat(among, to_big))).alias("m"))
        .select("bucket", "node", "component", "m.*"))
    out = stage(y.join(sets, "node").groupBy("bucket", "kind", "i", "j")
                .applyInArrow(meet, "src long, dst long"), "near-links")
    unstage(x)
    return out


def near_duplicates(docs: DataFrame, shingle: int = 5, limit: int = 80, bands: int = 40, rows: int = 7,
                    slack: float = 0.1, row_col: str | None = None) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept and the row number.

    Links join documents whose sets have ``100 * intersection >= limit * union``; component_id is the
    smallest doc_id reachable, itself included.
    """
    m = bands * rows
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    docs = docs.select("doc_id", row.alias("row"), F.col("text").cast("string").alias("text"))
    with small_batches(docs.sparkSession, _BATCH):
        whole = stage(sketch(docs, shingle, bands, rows), "near-sketches")
    # Classes of equal sets, named by their smallest (id, row).
    named = F.struct("doc_id", "row", "text_key")
    classes = stage(whole.filter(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
                    .groupBy("set_key", "n_shingles")
                    .agg(F.min(named).alias("low"), F.first("registers").alias("registers"))
                    .select("set_key", "n_shingles", "registers", F.col("low.row").alias("rep"),
                            F.col("low.doc_id").alias("rep_id"), F.col("low.text_key").alias("text_key"),
                            F.monotonically_increasing_id().alias("node")), "near-classes")
    sketched = stage(whole.drop("registers", "text_key"), "near-rows")
    unstage(whole)
    keys = [F.xxhash64(F.lit(k), F.substring("registers", 2 * rows * k + 1, 2 * rows)) for k in range(bands)]
    spread = classes.select("node", F.explode(F.array(*keys)).alias("bucket"))
    # Buckets of two and more classes; of those with the same classes (two hashes over them agree) one.
    crowded = (spread.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("hub"),
                                            F.bit_xor(F.xxhash64("node")).alias("one"),
                                            F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("two"))
               .filter("n > 1").groupBy("n", "hub", "one", "two").agg(F.min("bucket").alias("bucket")))
    active = stage(spread.join(crowded.select("bucket", "hub"), "bucket"), "near-buckets")
    sets = _full_sets(docs, classes, active, shingle)
    pairs = (active.filter(F.col("node") != F.col("hub")).select(F.col("hub").alias("src"), F.col("node").alias("dst"))
             .distinct())
    links = _verified(pairs, classes, sets, limit, m, slack)
    component = _merge(None, links)
    unstage(links)
    links = _contested(active, component, classes, sets, limit)
    if not links.isEmpty():
        component = _merge(component, links)
    for done in (links, sets, active):
        unstage(done)
    by_class = (classes.join(component, "node", "left")
                .select("set_key", "n_shingles", F.struct("rep_id", "rep").alias("own"),
                        F.coalesce("component", "node").alias("component")))
    lowest = by_class.groupBy("component").agg(F.min("own").alias("low"))
    by_class = by_class.join(lowest, "component").select("set_key", "n_shingles", "low")
    alone = F.col("set_key").isNull() | F.col("doc_id").isNull()
    cols = ["doc_id", "n_shingles", "component_id", "kept", F.col("row").alias(ROW)]
    linked = (sketched.filter(~alone).select("doc_id", "row", "n_shingles", "set_key")
              .join(by_class, ["set_key", "n_shingles"])
              .withColumn("component_id", F.col("low.rep_id"))
              .withColumn("kept", F.col("low.rep") == F.col("row")))
    own = (sketched.filter(alone).withColumn("component_id", F.col("doc_id")).withColumn("kept", F.lit(True)))
    out = stage(linked.select(*cols).unionByName(own.select(*cols)), "near-result")
    for done in (sketched, classes, component):
        unstage(done)
    return out


def drop_near_copies(docs: DataFrame, shingle: int = 5, limit: int = 80) -> DataFrame:
    """``docs`` with one document of every group of near-duplicates, all its columns unchanged."""
    rows = with_rows(docs, "near-docs")
    losers = (near_duplicates(rows, shingle, limit, row_col=ROW).filter(~F.col("kept")).select(ROW))
    return without(rows, losers)
