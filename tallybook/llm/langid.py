"""Language identification by interpolated Kneser-Ney character models.

Counting runs in Spark over every training text: texts are lower-cased, anything but letters becomes
one space, and each four-character window is packed into 64 bits (16 a character), counted per
batch by sorting and summed per (language, window). From these counts the models follow: order 4 with
raw counts, the lower orders with continuation counts, an absolute discount n1 / (n1 + 2 n2) each, all
in sorted arrays that are searched by bisection. The language with the lowest cross-entropy per
character wins. A calibration fold of the training texts, not counted, gives each language the
``calibrate`` quantile of its own cross-entropy; a text above its language's limit is not accepted.

Every counted window is kept, whatever their number: the models grow with the distinct windows of the
training texts. They are fetched one language at a time, and driver and executors hold all of them.

Rules: null texts and those without a letter are ``und`` with score 0; rows with null text or language
teach nothing; without any training row everything is ``und``; equal entropies go to the first
language by name. Characters beyond the basic plane share 6,400 codes. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import bucket_of_id
from tallybook.session import stage

START = 1          # three of these stand before every text
SPACE = 32
_RUN = 1_500_000   # characters handled at once


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x10000)])


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed windows of all texts, the text each belongs to, and the letters of each text."""
    mark = chr(START) * 3 + " "
    joined = mark + mark.join(t.replace(chr(START), " ") + " " for t in texts)
    c = np.frombuffer(joined.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    private = (c >= 0xE000) & (c < 0xF900)            # no letters; their codes stand for far ones below
    if private.any():
        c = np.where(private, SPACE, c).astype(np.uint32)
    if c.max(initial=0) > 0xFFFF:
        far = c > 0xFFFF
        kinds, where = np.unique(c[far], return_inverse=True)
        coded = np.array([0xE000 + k % 0x1900 if chr(k).isalpha() else SPACE for k in kinds.tolist()])
        c = c.copy()
        c[far] = coded[where]
    letter = _letters()[c] | ((c >= 0xE000) & (c < 0xF900))
    c = np.where(letter | (c == START), c, SPACE).astype(np.uint64)
    kept = np.ones(len(c), bool)
    kept[1:] = (c[1:] != SPACE) | (c[:-1] != SPACE)
    c, letter = c[kept], letter[kept]
    first = np.zeros(len(c), np.int64)
    first[1:] = (c[1:] == START) & (c[:-1] != START)
    owner = np.cumsum(first)
    n_letters = np.bincount(owner, letter, len(texts)).astype(np.int64)
    at = np.flatnonzero(c != START)
    keys = c[at] | c[at - 1] << np.uint64(16) | c[at - 2] << np.uint64(32) | c[at - 3] << np.uint64(48)
    return keys, owner[at], n_letters


def _slices(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    at, own, size = 0, [], 0
    for k, t in enumerate(texts):
        own.append(t or "")
        size += len(own[-1])
        if size >= _RUN:
            yield at, own
            at, own, size = k + 1, [], 0
    if own:
        yield at, own


def count_windows(rows: DataFrame) -> DataFrame:
    """Rows (lang, text) → (lang, window, n) over all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for at, texts in _slices(batch.column(1).to_pylist()):
                own = langs[at:at + len(texts)]
                names = sorted(set(own))
                code = np.array([names.index(x) for x in own])
                keys, owner, n_letters = windows(texts)
                which = np.where(n_letters > 0, code, -1)[owner]
                for k, name in enumerate(names):
                    key, n = np.unique(keys[which == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(key), pa.string()), pa.array(key.view(np.int64)),
                         pa.array(n.astype(np.int64))], names=["lang", "window", "n"])
    return (rows.mapInArrow(count, "lang string, window long, n long")
            .groupBy("lang", "window").agg(F.sum("n").alias("n")))


class _Order:
    """One order of one model: sorted n-grams with counts, sorted histories with sums and types."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.keys, self.n = keys, n.astype(np.float64)
        ones, twos = (n == 1).sum(), (n == 2).sum()
        self.discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        self.history, first = np.unique(keys >> np.uint64(16), return_index=True)
        self.total = np.add.reduceat(self.n, first)
        self.types = np.diff(np.append(first, len(keys))).astype(np.float64)

    def mix(self, keys: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Interpolated probability of ``keys`` given the next lower order's."""
        i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        n = np.where(self.keys[i] == keys, self.n[i], 0.0)
        h = keys >> np.uint64(16)
        j = np.minimum(np.searchsorted(self.history, h), len(self.history) - 1)
        known = self.history[j] == h
        d = self.discount
        own = (np.maximum(n - d, 0) + d * self.types[j] * lower) / self.total[j]
        return np.where(known, own, lower)


class Model:
    """Interpolated Kneser-Ney model of one language from its windows."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        self.orders = [_Order(keys, n)]
        for size in (3, 2, 1):                    # continuation counts: distinct characters before
            keys, n = np.unique(keys & np.uint64((1 << 16 * size) - 1), return_counts=True)
            self.orders.append(_Order(keys, n))
        self.floor = 1.0 / (len(keys) + 1)

    def prob(self, keys: np.ndarray) -> np.ndarray:
        p = np.full(len(keys), self.floor)
        for size, order in zip((1, 2, 3, 4), reversed(self.orders), strict=True):
            mask = np.uint64((1 << 16 * size) - 1)
            p = order.mix(keys & mask, p)
        return p


class Models:
    """All languages: one sorted array of every known window with a column of log2 probabilities each."""

    def __init__(self, by_lang: dict[str, Model]):
        self.names = sorted(by_lang)
        self.models = [by_lang[x] for x in self.names]
        self.keys = np.unique(np.concatenate([m.orders[0].keys for m in self.models])) \
            if by_lang else np.zeros(0, np.uint64)
        self.logs = np.stack([np.log2(m.prob(self.keys)) for m in self.models], axis=1).astype(
            np.float32) if by_lang else np.zeros((0, 0), np.float32)
        self.limits = np.full(len(self.names), np.inf)

    def entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy per character (texts, languages), characters and letters of each text."""
        keys, owner, n_letters = windows(texts)
        i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        logs = self.logs[i]
        missed = np.flatnonzero(self.keys[i] != keys)
        if len(missed):
            rare, where = np.unique(keys[missed], return_inverse=True)
            logs[missed] = np.stack([np.log2(m.prob(rare)) for m in self.models], axis=1)[where]
        n = np.bincount(owner, minlength=len(texts))
        bits = np.stack([np.bincount(owner, logs[:, k], len(texts)) for k in range(len(self.names))], axis=1)
        return -bits / np.maximum(n, 1)[:, None], n, n_letters

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float, bool]]:
        """(language, score, cross-entropy, accepted) of each text."""
        out = []
        if not self.names:
            return [("und", 0.0, None, False)] * len(texts)
        for _, own in _slices(texts):
            bits, n, n_letters = self.entropy(own)
            best = bits.argmin(axis=1)
            lead = bits[np.arange(len(own)), best][:, None]
            score = 1 / np.exp2(-np.minimum((bits - lead) * np.minimum(n, 64)[:, None], 500)).sum(axis=1)
            for k, b in enumerate(best.tolist()):
                low = float(lead[k, 0])
                out.append((self.names[b], float(score[k]), low, bool(low <= self.limits[b]))
                           if n_letters[k] else ("und", 0.0, None, False))
        return out


_PREDICTED = "struct<lang:string,score:double,entropy:double,accepted:boolean>"


def predict_column(models: Models, spark, text_col: str = "text") -> Column:
    shared = spark.sparkContext.broadcast(models)      # every window: grows with the corpus

    @F.arrow_udf(_PREDICTED)
    def predict(texts: pa.Array) -> pa.Array:
        lang, score, bits, ok = zip(*(shared.value.predict(texts.to_pylist()) or [()] * 4), strict=True) \
            if len(texts) else ([], [], [], [])
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64()),
             pa.array(ok, pa.bool_())], ["lang", "score", "entropy", "accepted"])
    return predict(F.col(text_col).cast("string"))


def train(rows: DataFrame, calibrate: float = 0.995, fold: int = 20) -> Models:
    """Models from rows (doc_id, text, lang), all to be learned from; one in ``fold`` calibrates."""
    spark = rows.sparkSession
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    aside = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(fold)) == 0
    counts = stage(count_windows(rows.filter(~aside).select("lang", "text")), "langid-counts")
    by_lang = {}
    for r in counts.select("lang").distinct().collect():
        own = counts.filter(F.col("lang") == r["lang"]).select("window", "n").toArrow()
        by_lang[r["lang"]] = Model(own["window"].to_numpy().view(np.uint64), own["n"].to_numpy())
    models = Models(by_lang)
    if models.names:
        seen = (rows.filter(aside).select("lang", predict_column(models, spark).alias("p"))
                .filter((F.col("p.lang") == F.col("lang")) & F.col("p.entropy").isNotNull())
                .groupBy("lang").agg(F.percentile_approx("p.entropy", F.lit(calibrate)).alias("limit")))
        for r in seen.collect():
            models.limits[models.names.index(r["lang"])] = r["limit"]
    return models


def held_out(id_col: str = "doc_id") -> Column:
    """Documents never learned from."""
    return F.coalesce(bucket_of_id(id_col, 3) == 1, F.lit(True))


def identify(docs: DataFrame, models: Models) -> DataFrame:
    """doc_id, held_out, lang_pred, score, entropy, accepted of every document."""
    return (docs.select("doc_id", held_out().alias("held_out"),
                        predict_column(models, docs.sparkSession).alias("p"))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score",
                    "p.entropy", "p.accepted"))
