"""Packing as vector bin packing with the dot-product heuristic.

A sequence (bin) has three limits at once: tokens, segments and loss-bearing tokens. The open bin
takes, of the items that fit in all three, the one whose demand has the largest dot product with
what is left in the bin (both as shares of the limits), so an item that uses the limits the bin has
most of goes first. Where cutting is allowed, what remains of a bin is filled with the front of the
largest item left, so only the last bin of a run of documents is padded noticeably.

Documents are tokenised once, in their own Spark task, and packed there in runs of at most
``run_tokens`` tokens; the pieces, some numbers each, are written: no shuffle, memory bounded by the run and the longest document, and a lost
task is simply run again. Text order and grouping come from the input's partitions.

``pack_examples`` packs whole examples whose tokens bear loss in part (instruction data) under all three
limits; ``pack_documents`` cuts plain documents, all of whose tokens bear loss.

Rules: null text counts as empty (its document is the end id alone); repeated rows are packed each;
an item larger than the limits is first cut into full sequences; a sequence's unused rest is padding.
Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import small_batches, text_or_empty
from tallybook.session import stage

END_ID = 1
PIECES = ("doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, loss_tokens long")


def pack_vectors(items: np.ndarray, limits: np.ndarray, cut: bool = False,
                 least_cut: int = 8) -> list[list[tuple[int, int, int]]]:
    """Bins of (item, first token, tokens).

    ``items``: (n, 3) of tokens, segments and loss tokens, each row within ``limits`` (else ValueError). With
    ``cut`` every token of an item must bear loss alike, as in plain documents.
    """
    if (items > limits).any():
        raise ValueError("an item is larger than a limit: cut it or leave it out first")
    classes: dict[tuple[int, ...], list[tuple[int, int]]] = {}
    for i, v in enumerate(map(tuple, items.tolist())):
        classes.setdefault(v, []).append((i, 0))
    if cut:                                        # every length a cut can leave
        top = max((v[0] for v in classes), default=0)
        for n in range(1, top):
            classes.setdefault((n, 1, n), [])
    order = sorted(classes)
    index = {v: k for k, v in enumerate(order)}
    demand = np.array(order, np.float64).reshape(-1, 3)
    share = demand / limits
    stock = [classes[v] for v in order]
    there = np.array([len(s) > 0 for s in stock])
    left = sum(map(len, stock))
    bins = []
    while left:
        room, own = limits.astype(np.float64), []
        while left:
            fits = there & (demand <= room).all(axis=1)
            if not fits.any():
                break
            k = int(np.where(fits, share @ (room / limits), -1.0).argmax())
            item, first = stock[k].pop()
            there[k] = bool(stock[k])
            left -= 1
            own.append((item, first, order[k][0]))
            room -= demand[k]
        spare = int(min(room[0], room[2]))
        if cut and left and spare >= least_cut and room[1] >= 1:
            k = int(np.flatnonzero(there)[-1])     # the longest; it does not fit, so it is longer
            item, first = stock[k].pop()
            there[k] = bool(stock[k])
            own.append((item, first, spare))
            rest = order[k][0] - spare
            r = index[(rest, 1, rest)]
            stock[r].append((item, first + spare))
            there[r] = True
        bins.append(own)
    return bins


class _Pieces(dict):
    """Number of every piece met; the ids of new ones wait in ``found``."""

    def __init__(self, ids_of):
        super().__init__({"\n": 0})                    # the mark between words has no ids
        self.ids_of, self.found = ids_of, [[]]

    def __missing__(self, piece: str) -> int:
        got = self[piece] = len(self)
        self.found.append(self.ids_of(piece))
        return got


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Positions first, first + 1, .. of n entries each, one after the other."""
    ends = np.cumsum(n)
    out = np.repeat((first - (ends - n)).astype(np.int32), n)      # tables and slices are far below 2**31
    out += np.arange(len(out), dtype=np.int32)
    return out


class WordIds:
    """Token ids of texts, gathered from a table of pieces over the tokenizer's model.

    The vocabulary's pre-tokenizer never joins across white space, so a text's ids are those of its words in
    turn. Arrow splits the texts and numbers their distinct words; words of printable ASCII and Latin-1 letters
    are lower-cased and cut into pieces by the same pattern here, and only pieces not met before reach
    the model; any other word goes through the whole tokenizer. The ids of words, then of texts, are gathered by
    position. Texts that hold one of the vocabulary's added tokens are cut there first, as the tokenizer does. The
    table is emptied once it has more than ``most`` pieces.
    """

    #: Fixed values of the vocabulary file: its pre-tokenizer's pattern, for the letters handled here.
    PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ÿß]+|[0-9]|[^\s0-9a-zà-öø-ÿß]+|\n")
    PLAIN = "^[\x21-\x7eÀ-ÖØ-öø-ÿ]*$"

    def __init__(self, tokenizer_file: str, most: int = 300_000):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(tokenizer_file)
        self.model, self.most = self.tok.model, most
        self.added = {t.content: n for n, t in self.tok.get_added_tokens_decoder().items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        # The byte-level alphabet: printable bytes stand for themselves, the others follow from 256.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.letter = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self._forget()

    def _forget(self) -> None:
        self.pieces = _Pieces(self._piece)
        self.table = np.zeros(0, np.uint32)            # ids of all pieces, one after the other
        self.first = np.zeros(1, np.int64)             # where each piece's begin, and the end

    def _piece(self, piece: str) -> list[int]:
        coded = piece if piece.isascii() else "".join(map(self.letter.get, piece.encode()))
        return [t.id for t in self.model.tokenize(coded)]

    def _cut(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words in turn and how many each has."""
        if len(self.pieces) > self.most:
            self._forget()
        said = self.PIECE.findall("\n".join([*words, ""]).lower())
        number = np.fromiter(map(self.pieces.__getitem__, said), np.int64, len(said))
        if found := self.pieces.found:
            self.table = np.concatenate([self.table, np.array([i for f in found for i in f], np.uint32)])
            ends = self.first[-1] + np.cumsum([len(f) for f in found])
            self.first = np.concatenate([self.first, ends])
            self.pieces.found = []
        n = self.first[number + 1] - self.first[number]
        ids = self.table[_spread(self.first[number], n)]
        ends = np.cumsum(n)[number == 0]
        return ids, np.diff(ends, prepend=0)

    def gather(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in turn and the position where each text's begin (one more at the end)."""
        import pyarrow.compute as pc
        texts = texts.cast(pa.large_string())
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        words, at = coded.dictionary, coded.indices.to_numpy()
        plain = pc.match_substring_regex(words, self.PLAIN).to_numpy(zero_copy_only=False)
        ids, size = self._cut(words.filter(pa.array(plain)).to_pylist())
        odd = [self.tok.encode(w, add_special_tokens=False).ids for w in words.filter(pa.array(~plain)).to_pylist()]
        n = np.zeros(len(words), np.int64)
        n[plain], n[~plain] = size, [len(o) for o in odd]
        first = np.zeros(len(words), np.int64)
        first[plain] = np.cumsum(size) - size
        first[~plain] = len(ids) + np.cumsum(n[~plain]) - n[~plain]
        ids = np.concatenate([ids, np.array([i for o in odd for i in o], np.uint32)])
        ends = np.concatenate([[0], np.cumsum(n[at])])
        ids = ids[_spread(first[at], n[at])]
        starts = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])]
        special = np.zeros(len(texts), bool)
        for content in self.added:
            special |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        if not special.any():
            return ids, starts
        parts = [self._with_added(texts[k].as_py()) if special[k] else ids[starts[k]:starts[k + 1]]
                 for k in range(len(texts))]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _with_added(self, text: str) -> np.ndarray:
        out = []
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                out.append(np.array([self.added[part]], np.uint32))
            elif part:
                out.append(self.gather(pa.array([part]))[0])
        return np.concatenate([np.zeros(0, np.uint32), *out])

    def ids(self, text: str) -> bytes:
        return self.gather(pa.array([text]))[0].tobytes()


def _slices(column: pa.Array, most: int = 4_000_000) -> Iterator[tuple[int, pa.Array]]:
    """Slices of a string column of about ``most`` bytes each, one text at least."""
    import pyarrow.compute as pc
    ends = np.cumsum(pc.binary_length(column).to_numpy(), dtype=np.int64)
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, column.slice(at, to - at)
        at = to


@cache
def word_ids(tokenizer_file: str) -> WordIds:
    """One table per Python worker, kept from task to task."""
    return WordIds(tokenizer_file)


def _runs(batches: Iterator[pa.RecordBatch], run_tokens: int, tokenizer_file: str):
    """Runs of (ids of the documents' column, token arrays), at most about ``run_tokens`` tokens."""
    words = word_ids(tokenizer_file)
    end = np.array([END_ID], np.uint32)
    ids, arrays, size = [], [], 0
    for batch in batches:
        names = batch.column(0).to_pylist()
        for at, texts in _slices(batch.column(1)):
            tokens, starts = words.gather(texts)
            for k in range(len(texts)):
                a = np.concatenate([tokens[starts[k]:starts[k + 1]], end])
                ids.append(names[at + k])
                arrays.append(a)
                size += len(a)
                if size >= run_tokens:
                    yield ids, arrays
                    ids, arrays, size = [], [], 0
    if ids:
        yield ids, arrays


def pack_documents(docs: DataFrame, tokenizer_file: str, max_tokens: int = 2048,
                   max_segments: int = 64, max_loss: int | None = None,
                   run_tokens: int = 4_000_000) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens.

    ``max_loss`` (default ``max_tokens``): loss-bearing tokens a sequence may hold; every token of a
    plain document bears loss.
    """
    limits = np.array([max_tokens, max_segments, max_loss or max_tokens])
    whole = int(min(limits[0], limits[2]))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        for ids, arrays in _runs(batches, run_tokens, tokenizer_file):
            out, items, owner = [], [], []

            def put(doc: int, start: int, length: int, seq: int, offset: int, out=out, arrays=arrays):
                a = arrays[doc]
                out.append((doc, start, length,
                            zlib.crc32(a[start:start + length].astype("<u4")),
                            len(a), seq, offset))
            for doc, a in enumerate(arrays):
                for start in range(0, len(a) - whole + 1, whole):
                    put(doc, start, whole, sequence, 0)
                    sequence += 1
                if rest := len(a) % whole:
                    items.append((rest, 1, rest))
                    owner.append((doc, len(a) - rest))
            for own in pack_vectors(np.array(items, np.int64).reshape(-1, 3), limits, cut=True):
                offset = 0
                for item, first, length in own:
                    doc, start = owner[item]
                    put(doc, start + first, length, sequence, offset)
                    offset += length
                sequence += 1
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[d] for d in cols[0]], id_type)]
                + [pa.array(c, pa.int64()) for c in (*cols[1:], cols[2])], names=names)

    kind = docs.schema["doc_id"].dataType
    schema = PIECES.format(id=kind.simpleString())
    names = [x.split()[0] for x in schema.split(", ")]
    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(kind)
    packed = docs.select("doc_id", text_or_empty("text").alias("text")).mapInArrow(pack, schema)
    with small_batches(docs.sparkSession):       # few texts at once in the workers; the pieces are written once
        return stage(packed, "packed")


def pack_examples(examples: DataFrame, max_tokens: int = 2048, max_segments: int = 64, max_loss: int | None = None,
                  run_examples: int = 20_000) -> DataFrame:
    """Whole examples (example_id, tokens, loss_tokens) → the same columns with sequence_id and offset.

    No sequence holds more than ``max_tokens`` tokens, ``max_segments`` examples or ``max_loss`` (default
    ``max_tokens``) loss-bearing tokens. An example over a limit, or without a token count, fits nowhere: its
    sequence_id and offset are null. Null loss_tokens count as none; each task packs runs of at most
    ``run_examples`` examples, so nothing is shuffled.
    """
    limits = np.array([max_tokens, max_segments, max_loss or max_tokens])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, run_examples):
                run = batch.slice(at, run_examples)
                tokens, loss = (run.column(k).fill_null(v).to_numpy() for k, v in ((1, -1), (2, 0)))
                items = np.stack([tokens, np.ones_like(tokens), loss], axis=1)
                fits = np.flatnonzero((tokens >= 0) & (items <= limits).all(axis=1))
                where, offset = np.full(len(items), -1, np.int64), np.zeros(len(items), np.int64)
                for own in pack_vectors(items[fits], limits):
                    filled = 0
                    for k, _, n in own:
                        where[fits[k]], offset[fits[k]] = sequence, filled
                        filled += n
                    sequence += 1
                out = where < 0
                yield pa.RecordBatch.from_arrays(
                    [*(run.column(k) for k in range(3)), pa.array(where, mask=out), pa.array(offset, mask=out)],
                    names=["example_id", "tokens", "loss_tokens", "sequence_id", "offset"])

    kind = examples.schema["example_id"].dataType.simpleString()
    return (examples.select("example_id", F.col("tokens").cast("long"), F.col("loss_tokens").cast("long"))
            .mapInArrow(pack, f"example_id {kind}, tokens long, loss_tokens long, sequence_id long, offset long"))
