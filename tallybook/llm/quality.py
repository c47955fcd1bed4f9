"""Quality classifier: histogram gradient-boosted trees over document statistics.

Spark computes the statistics of whole texts (Arrow batches); the trees are grown on binned
statistics of a bounded sample of labelled rows (``max_rows``, by a hash of the id, so the same
rows are taken whatever the layout) and flattened into arrays: node k of a tree has children 2k+1
and 2k+2, so scoring walks all trees of all documents of a batch level by level in numpy.

Rules: null text counts as empty and is scored like any other; null labels and labels of unknown
documents are ignored; several labels of one document count as their mean, rounded; repeated
document rows enter the training set once, with their mean statistics; without any labelled row
every score is 1, with one class only all scores are that class's rate. The statistics never use
labels, language, source or id. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tallybook.llm.common import bucket_of_id

STATS = ["log_bytes", "log_words", "word_len", "word_len_sd", "upper", "digit", "space", "symbol",
         "exclaim", "bar", "mark", "stop", "caps_words", "symbol_end", "distinct", "top_word",
         "repeat_next", "distinct_pairs", "lines", "line_len", "distinct_lines", "short_lines"]

_SYMBOLS = b"#$%&*@^~_<>={}[]\\/"


def statistics(text: str | None) -> list[float]:
    """The ``STATS`` of one whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    c = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    m = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.float64, len(words))
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    caps = sum(x.isupper() and len(x) > 1 for x in counts)
    ends = sum(v for x, v in counts.items() if x[-1] in _SYMBOLS or x[-2:] == b"!!")
    return [
        np.log1p(len(raw)), np.log1p(len(words)), lengths.sum() / m,
        lengths.std() if len(words) else 0.0, c[65:91].sum() / n, c[48:58].sum() / n,
        (c[32] + c[9:14].sum()) / n, sum(int(c[b]) for b in _SYMBOLS) / n, c[33] / n, c[124] / n,
        (c[44] + c[59] + c[58]) / n, (c[46] + c[63]) / n, caps / max(1, len(counts)), ends / m,
        len(counts) / m, max(counts.values(), default=0) / m,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / m, pairs / m,
        np.log1p(len(lines)), np.log1p(len(raw) / k), len(set(lines)) / k,
        sum(len(x) < 30 for x in lines) / k]


@F.arrow_udf(ArrayType(DoubleType()))
def document_statistics(texts: pa.Array) -> pa.Array:
    return pa.array([statistics(t) for t in texts.to_pylist()], pa.list_(pa.float64()))


@dataclass
class Trees:
    """Flattened boosted trees: ``feature`` and ``limit`` (trees, 2**depth - 1), ``leaf`` (trees, 2**depth)."""

    base: float
    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of statistics."""
        total = np.full(len(x), self.base)
        if self.feature.size:
            trees = np.arange(len(self.feature))
            rows = np.arange(len(x))[:, None]
            at = np.zeros((len(x), len(trees)), np.int64)
            for _ in range(int(np.log2(self.leaf.shape[1]))):
                right = x[rows, self.feature[trees, at]] > self.limit[trees, at]
                at = 2 * at + 1 + right
            total += self.leaf[trees, at - self.feature.shape[1]].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64,
         rate: float = 0.15, ridge: float = 1.0, least: float = 4.0) -> Trees:
    """Fit by Newton boosting of the logistic loss on per-statistic histograms."""
    n, width = x.shape if len(x) else (0, len(STATS))
    prior = (y.sum() + 1) / (n + 1)
    base = float(np.log(prior / (1 - prior))) if prior < 1 else 30.0
    none = np.zeros((0, 2 ** depth - 1))
    if n == 0 or y.min() == y.max():
        return Trees(base, none.astype(np.int64), none, np.zeros((0, 2 ** depth)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
    feature = np.zeros((trees, 2 ** depth - 1), np.int64)
    limit = np.full((trees, 2 ** depth - 1), np.inf)
    leaf = np.zeros((trees, 2 ** depth))
    raw = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)                       # position inside the current level
        for d in range(depth):
            size = 2 ** d
            gain = np.zeros((width, size))
            cut = np.zeros((width, size), np.int64)
            for j in range(width):
                key = node * bins + binned[j]
                g = np.bincount(key, grad, size * bins).reshape(size, bins).cumsum(axis=1)
                h = np.bincount(key, hess, size * bins).reshape(size, bins).cumsum(axis=1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                value = (g ** 2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge)
                         - g_all ** 2 / (h_all + ridge))
                value[(h < least) | (h_all - h < least)] = 0
                value[:, len(edges[j]):] = 0               # only cuts at a real edge
                cut[j] = value.argmax(axis=1)
                gain[j] = value.max(axis=1)
            best = gain.argmax(axis=0)
            for k in range(size):
                if gain[best[k], k] > 1e-9:
                    feature[t, size - 1 + k] = best[k]
                    limit[t, size - 1 + k] = edges[best[k]][cut[best[k], k]]
            at = size - 1 + node
            node = 2 * node + (x[np.arange(n), feature[t, at]] > limit[t, at])
        g = np.bincount(node, grad, 2 ** depth)
        h = np.bincount(node, hess, 2 ** depth)
        leaf[t] = -rate * g / (h + ridge)
        raw += leaf[t, node]
    return Trees(base, feature, limit, leaf)


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Rows never learned from: crc32 of the id's text, modulo ``parts``, equals ``part``."""
    return F.coalesce(bucket_of_id(id_col, parts) == part, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> Trees:
    """Trees from at most about ``max_rows`` labelled, not held-out documents."""
    marked = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.round(F.avg("quality")).alias("y")))
    n = marked.count()
    parts = 1_000_000
    take = parts if n <= max_rows else int(parts * max_rows / n)
    # At most about max_rows pairs of numbers, whatever the data: a proven bound for the broadcast.
    sample = marked.filter(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < take)
    rows = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
            .select("doc_id", "y", document_statistics("text").alias("x"))
            .groupBy("doc_id", "y").agg(*[F.avg(F.col("x")[j]).alias(f"x{j}")
                                          for j in range(len(STATS))])
            .orderBy("doc_id").toPandas())
    return grow(rows[[f"x{j}" for j in range(len(STATS))]].to_numpy(np.float64),
                rows["y"].to_numpy(np.float64))


def score_column(model: Trees, text_col: str = "text") -> Column:
    """Score of a text column, 0 to 1."""
    @F.arrow_udf(DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        if not len(texts):
            return pa.array([], pa.float64())
        x = np.array([statistics(t.as_py()) for t in texts], np.float64)
        return pa.array(model.score(x), pa.float64())
    return score(F.col(text_col).cast("string"))


def score_documents(docs: DataFrame, model: Trees, limit: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted (1 where score >= ``limit``)."""
    return (docs.select("doc_id", held_out().alias("held_out"), score_column(model).alias("score"))
            .withColumn("predicted", (F.col("score") >= limit).cast("int")))
