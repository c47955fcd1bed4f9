"""Benchmark decontamination: a BM25 inverted index of the test items, queried with every passage of
every document by block-max WAND, then verified on question and answer.

An item is indexed in segments of at most ``SEGMENT`` words, each half over the next, and a passage is a window of
twice that, half overlapping: an excerpt of ``SEGMENT`` words, wherever it starts, covers three quarters of some
segment and lies in some passage whole. Impacts are divided by the segment's own
score: a passage's score is the share of a segment's weight that it covers, and one threshold serves
all. Per batch of passages the block maxima of their terms are first added up for every block at once (the
shallow look of block-max WAND); only a passage with a live block walks the postings, by pivots, and
retrieves every segment above the threshold. An item with question and answer counts when ``overlap`` of the
five-word shingles of each occur in the whole document. An item without an answer (or without a question)
counts when that share of a retrieved segment's shingles does, so that an excerpt is enough; the largest such
share is its ``question_overlap``, its ``answer_overlap`` is null. Items of under ``least_words`` words must
occur word for word, question and answer each in a row.

The benchmark is split by a hash into parts of about ``index_chars`` characters. One part at a time is fetched,
indexed and sent to the tasks, its hits are written before the next part is fetched: neither the driver nor a task ever
holds more than one part, however large the benchmark, and each part costs one look at the documents, which are
neither shuffled nor collected.

Rules: null text counts as empty; items without a word are in no document; repeated items and documents
each count; an empty benchmark finds nothing. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallybook.llm.common import text_or_empty
from tallybook.session import stage

_WORD = re.compile(r"\w+")
SHINGLE = 5
_SHARES = ["score", "question_overlap", "answer_overlap"]
SEGMENT = 32


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingles(words: list[str], n: int = SHINGLE) -> set[tuple[str, ...]]:
    n = min(n, len(words)) or 1
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


def segments_of(words: list[str]) -> list[list[str]]:
    """Segments of equal size, ``SEGMENT`` words at most, each half over the next."""
    n = len(words)
    halves = 2 * -(-n // SEGMENT)
    at = [n * k // halves for k in range(halves + 1)] if n else []
    return [words[a:b] for a, b in zip(at, at[2:])]


class Index:
    """Inverted index of the segments of some items, with block maxima."""

    def __init__(self, items: list[tuple], k1: float = 1.2, b: float = 0.75, block: int = 8):
        """``items``: (item id, question words, answer words)."""
        self.items = items
        #: Question and answer of items that have both; else the item's segments are verified.
        self.shingles = [(shingles(q), shingles(a)) if q and a else None for _, q, a in items]
        self.item_of: list[int] = []                # item of each segment
        self.segments: list[set | None] = []        # shingles of each segment that is verified
        counts = []
        for i, (_, q, a) in enumerate(items):
            for own in segments_of(q + a):
                counts.append(Counter(own))
                self.item_of.append(i)
                self.segments.append(None if q and a else shingles(own))
        n = len(counts)
        mean = sum(c.total() for c in counts) / max(1, n)
        df = Counter(t for c in counts for t in c)
        self.terms = {t: k for k, t in enumerate(sorted(df))}
        postings: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for i, c in enumerate(counts):
            size = k1 * (1 - b + b * c.total() / mean)
            own = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * f * (k1 + 1) / (f + size)
                   for t, f in c.items()}
            total = sum(own.values())
            for t, w in own.items():
                postings[self.terms[t]].append((i, w / total))
        self.docs = [[i for i, _ in p] for p in postings]
        self.impact = [[w for _, w in p] for p in postings]
        self.top = np.array([max(w) for w in self.impact] or [0.0])
        self.ends = [[d[min(k + block, len(d)) - 1] for k in range(0, len(d), block)] for d in self.docs]
        self.tops = [[max(w[k:k + block]) for k in range(0, len(w), block)] for w in self.impact]
        # The shallow look: maxima by fixed ranges of ``block`` segments, term after term.
        shallow = [(t, k, max(w for i, w in p if i // block == k))
                   for t, p in enumerate(postings) for k in sorted({i // block for i, _ in p})]
        self.n_blocks = -(-n // block) or 1
        self.at_block = np.array([k for _, k, _ in shallow], np.int64)
        self.block_top = np.array([w for _, _, w in shallow], np.float64)
        self.first = np.searchsorted(np.array([t for t, _, _ in shallow], np.int64),
                                     np.arange(len(self.terms) + 1))

    def retrieve(self, terms: list[int], least: float) -> list[tuple[int, float]]:
        """Block-max WAND: all (item, score) with score >= ``least`` for distinct ``terms``."""
        done = len(self.item_of)
        cursors = [[self.docs[t][0], 0, t] for t in terms]      # current item, position, term
        found = []

        def move(c: list, to: int) -> None:
            docs = self.docs[c[2]]
            c[1] = bisect_left(docs, to, c[1])
            c[0] = docs[c[1]] if c[1] < len(docs) else done
        while True:
            cursors = sorted((c for c in cursors if c[0] < done), key=lambda c: c[0])
            bound, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                bound += self.top[c[2]]
                if bound >= least:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            bound, edge = 0.0, done
            for c in cursors[:pivot + 1]:
                ends = self.ends[c[2]]
                k = bisect_left(ends, item)
                if k < len(ends):
                    bound += self.tops[c[2]][k]
                    edge = min(edge, ends[k] + 1)
            if bound < least:                                   # no item before the blocks end
                if pivot + 1 < len(cursors):
                    edge = min(edge, cursors[pivot + 1][0])
                for c in cursors[:pivot + 1]:
                    move(c, max(edge, item + 1))
            elif cursors[0][0] == item:
                score = sum(self.impact[c[2]][c[1]] for c in cursors[:pivot + 1])
                if score >= least:
                    found.append((item, score))
                for c in cursors[:pivot + 1]:
                    move(c, item + 1)
            else:
                for c in cursors[:pivot]:
                    if c[0] < item:
                        move(c, item)

    def live(self, win: np.ndarray, term: np.ndarray, n: int, least: float) -> np.ndarray:
        """Passages with a block whose maxima reach ``least`` (pairs of passage and distinct term)."""
        size = self.first[term + 1] - self.first[term]
        entry = np.arange(size.sum()) + np.repeat(self.first[term] - (np.cumsum(size) - size), size)
        bound = np.bincount(np.repeat(win, size) * self.n_blocks + self.at_block[entry],
                            self.block_top[entry], n * self.n_blocks)
        return np.flatnonzero(bound.reshape(n, self.n_blocks).max(axis=1) >= least - 1e-9)

    def search(self, texts: list[str | None], least: float, overlap: float) -> list[list]:
        """Verified hits of each text: (item id, best score, question overlap, answer overlap)."""
        words = [words_of(t) for t in texts]
        half = SEGMENT
        step, owner, base = [], [], 0
        ids = np.fromiter((self.terms.get(w, -1) for ws in words for w in ws), np.int64,
                          sum(map(len, words)))
        for d, ws in enumerate(words):
            n = max(1, -(-len(ws) // half))
            step.append(np.arange(len(ws)) // half + base + 1)
            owner += [d] * (n + 1)
            base += n + 1
        at = np.concatenate(step) if step else np.zeros(0, np.int64)
        at, ids = at[ids >= 0], ids[ids >= 0]
        # A word of half-window h is in the windows h - 1 and h.
        v = len(self.terms) or 1
        keys = np.unique(np.concatenate([at * v + ids, (at - 1) * v + ids]))
        win, term = keys // v, keys % v
        best: dict[tuple[int, int], tuple[float, set[int]]] = {}
        for w in self.live(win, term, base + 1, least):
            lo, hi = np.searchsorted(win, [w, w + 1])
            for segment, score in self.retrieve(term[lo:hi].tolist(), least):
                key = (owner[w], self.item_of[segment])
                top, found = best.get(key, (0.0, set()))
                best[key] = max(top, score), found | {segment}
        out: list[list] = [[] for _ in texts]
        seen: dict[int, set] = {}
        for (d, item), (score, found) in sorted(best.items(), key=lambda x: x[0]):
            if d not in seen:
                seen = {d: shingles(words[d])}

            def share(part: set, d=d, seen=seen) -> float:
                n = len(next(iter(part)))
                return len(part & (seen[d] if n == SHINGLE else shingles(words[d], n))) / len(part)
            if self.shingles[item]:
                shares = [share(part) for part in self.shingles[item]]
            else:
                shares = [max(share(self.segments[x]) for x in found)]
            if min(shares) >= overlap:
                out[d].append((self.items[item][0], score, *shares, *[None] * (2 - len(shares))))
        return out


class Exact:
    """Short items, found where their words stand in a row."""

    def __init__(self, items: list[tuple]):
        """``items``: (item id, question words, answer words), any but both empty."""
        self.by_run: dict[tuple, list[tuple]] = {}
        for i, q, a in items:
            self.by_run.setdefault(tuple(q or a), []).append((i, tuple(a) if q and a else None))
        self.sizes = sorted({len(x) for x in self.by_run})

    def search(self, texts: list[str | None], least: float, overlap: float) -> list[list]:
        """Hits of each text as those of an :class:`Index`."""
        out = []
        for text in texts:
            w = words_of(text)
            runs = {g for n in self.sizes if n <= len(w) for g in shingles(w, n)}
            out.append([(i, 1.0, 1.0, 1.0 if a else None) for run in sorted(runs & self.by_run.keys())
                        for i, a in self.by_run[run] if not a or (len(a) <= len(w) and a in shingles(w, len(a)))])
        return out


def item_parts(benchmark: DataFrame, index_chars: int = 1_000_000) -> Iterator[list[tuple]]:
    """All items that have words, in parts of about ``index_chars`` characters, one fetched at a time."""
    answer = text_or_empty("answer") if "answer" in benchmark.columns else F.lit("")
    items = benchmark.select("item_id", text_or_empty("text").alias("text"), answer.alias("answer"))
    chars = items.agg(F.sum(F.length("text") + F.length("answer"))).first()[0] or 0
    parts = -(-chars // index_chars) or 1
    for k in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).orderBy("item_id", "text").collect()
        block = [(r["item_id"], words_of(r["text"]), words_of(r["answer"])) for r in rows]
        if block := [x for x in block if x[1] or x[2]]:
            yield block


def searchers(items: list[tuple], least_words: int = 5) -> list[Index | Exact]:
    """What finds the items of one part: an index, and a table of items of under ``least_words`` words."""
    long = [x for x in items if len(x[1]) + len(x[2]) >= least_words]
    short = [x for x in items if len(x[1]) + len(x[2]) < least_words]
    return ([Index(long)] if long else []) + ([Exact(short)] if short else [])


def hits_type(id_type: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField("item_id", id_type),
                                     *[T.StructField(x, T.DoubleType()) for x in _SHARES]]))


def hits_column(index: Index | Exact, id_type: T.DataType, text_col: str = "text",
                least: float = 0.75, overlap: float = 0.5) -> Column:
    """Verified hits of a text column against one index."""
    kind = hits_type(id_type)
    arrow, names = to_arrow_type(kind), ["item_id", *_SHARES]

    @F.arrow_udf(kind)
    def hits(texts: pa.Array) -> pa.Array:
        out = []
        for at in range(0, len(texts), 256):
            out += index.search(texts.slice(at, 256).to_pylist(), least, overlap)
        return pa.array([[dict(zip(names, h, strict=True)) for h in hs] for hs in out], arrow)
    return hits(F.col(text_col).cast("string"))


def part_hits(benchmark: DataFrame, index_chars: int = 1_000_000) -> Iterator[Column]:
    """Hits of a text against one part of the benchmark after the other."""
    id_type = benchmark.schema["item_id"].dataType
    for items in item_parts(benchmark, index_chars):
        columns = [hits_column(x, id_type) for x in searchers(items)]
        yield F.concat(*columns) if len(columns) > 1 else columns[0]


def find_contamination(docs: DataFrame, benchmark: DataFrame, index_chars: int = 1_000_000) -> DataFrame:
    """One row per document and verified item: doc_id, item_id, score, question_overlap, answer_overlap."""
    none = F.array().cast(hits_type(benchmark.schema["item_id"].dataType))

    def rows(hits: Column) -> DataFrame:
        return docs.select("doc_id", F.explode(hits).alias("h")).select("doc_id", "h.*")
    found, last = [], none
    for hits in part_hits(benchmark, index_chars):
        if last is not none:
            found.append(stage(rows(last), "contamination"))
        last = hits
    return reduce(DataFrame.unionByName, found, rows(last))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, index_chars: int = 1_000_000) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    last = None
    for hits in part_hits(benchmark, index_chars):
        if last is not None:
            docs = stage(docs.filter(F.size(last) == 0), "clean-docs")
        last = hits
    return docs if last is None else docs.filter(F.size(last) == 0)
