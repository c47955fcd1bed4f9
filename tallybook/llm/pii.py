"""Personal data by bootstrapped contextual extraction.

One Arrow pass reads each whole text once: base spans by pattern (seeds) and, around them and around
every other identifier-like token, the words next to it. Two lexical patterns per slot, ``w2 w1 _`` and
``w1 _ v1``, link to the slot's token: the pattern-instance graph. A slot is a base span, an identifier-like
token, or a run of neighbouring number tokens (``(030) 1234 5678``). Spark scores the graph in rounds: a pattern's
confidence for a kind is the share of its distinct instances known to be of that kind (``support`` of
them at least); an unknown instance's score is the noisy-or of its patterns' confidences; instances at
``accept`` or above are known in the next round, and rounds go on until one adds none. Occurrences of the instances
found this way are added to the base spans, which always stay.

The graph holds identifier-like tokens only, edges are reduced to distinct (pattern, instance) pairs before
anything is counted, and every step is a partial aggregate or an equi-join, so no frequent pattern or token
gathers in one task.

Rules: null text counts as empty; offsets are code points, ends exclusive; each row is its own document,
repeated ids included. Extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import text_or_empty
from tallybook.session import stage, unstage

KINDS = ["email", "ip", "card", "phone"]

#: Fixed patterns of the base kinds. An e-mail's local part is taken leftwards from its @, an address
#: only starts where a run of digits starts: the same leftmost matches, in linear time.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_EDGE = ".,;:!?()[]{}\"'|<>*&%$#=`"
_WORD = re.compile(r"\S+")
_NUMBERS = re.compile(r"[ \t\u00a0]([0-9(][0-9()./-]*)(?=[\s.,;:!?]|\Z)")   # a number token after a single blank
_NUMBER = re.compile(r"[0-9(][0-9()./-]*")


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base kinds, by start, then kind."""
    out = []
    last, at = 0, text.find("@")
    while at >= 0:
        if m := DOMAIN.match(text, at + 1):
            start = last + len(text[last:at].rstrip(LOCAL))
            if start < at:
                out.append((start, m.end(), 0))
                last = m.end()
        at = text.find("@", max(at + 1, last))
    if "." in text:
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((*m.span(), 1))
    for m in CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and _luhn(digits):
            out.append((*m.span(), 2))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
                out.append((*m.span(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


def _like_identifier(token: str) -> bool:
    return len(token) >= 5 and ("@" in token or sum(c in "0123456789" for c in token) >= 3)


class _Words:
    """Words of a text by position, found once for all its slots."""

    def __init__(self, text: str):
        self.text = text
        self.spans = [m.span() for m in _WORD.finditer(text)]
        self.starts = [s for s, _ in self.spans]

    def patterns(self, start: int, end: int) -> list[str]:
        """Lexical patterns of a slot: the two words (or parts of words) before it, the one after."""
        k = bisect_left(self.starts, start)
        left = [self.text[s:min(e, start)] for s, e in self.spans[max(k - 2, 0):k]]
        j = bisect_left(self.starts, end)
        if j and self.spans[j - 1][1] > end:          # the rest of the word the slot ends in
            right = [self.text[end:self.spans[j - 1][1]]]
        else:
            right = [self.text[s:e] for s, e in self.spans[j:j + 1]]
        left = [w for x in left if (w := x.strip(_EDGE).lower())]
        right = [w for x in right if (w := x.strip(_EDGE).lower())]
        out = []
        if len(left) == 2:
            out.append(f"{left[0]} {left[1]} _")
        if left and right:
            out.append(f"{left[-1]} _ {right[0]}")
        return out


def slots_of(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, list[str]]]:
    """(start, end, kind or -1, instance, patterns) of base spans, other identifier-like tokens and number runs."""
    if not base and not _HINT.search(text):
        return []
    words = _Words(text)
    out = [(s, e, k, text[s:e].lower(), words.patterns(s, e)) for s, e, k in base]
    taken, over = sorted(base), 0
    done = 0
    for m in _HINT.finditer(text):
        if m.start() < done:
            continue
        k = bisect_left(words.starts, m.end()) - 1
        s, e = words.spans[k]
        s = max(s, done)
        token = text[s:e]
        if _NUMBER.fullmatch(token):
            while run := _NUMBERS.match(text, e):
                e = run.end()
            token = text[s:e]
        done = e
        lead = len(token) - len(token.lstrip(_EDGE.replace("(", "")))
        s += lead
        token = token[lead:].rstrip(_EDGE.replace(")", ""))
        if token.count("(") != token.count(")"):
            s += len(token) - len(token.lstrip("()"))
            token = token.strip("()")
        e = s + len(token)
        while over < len(taken) and taken[over][1] <= s:
            over += 1
        if _like_identifier(token) and not any(x[0] < e and x[1] > s for x in taken[over:over + 4]):
            out.append((s, e, -1, token.lower(), words.patterns(s, e)))
    return out


_SPAN = "struct<start:int,kind:int,end:int>"
_SCANNED = ("doc_id {id}, row long, base array<" + _SPAN + ">, slots array<struct<start:int,end:int,"
            "kind:int,instance:string,patterns:array<string>>>")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, row, base spans and slots of every text."""
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = _SCANNED.format(id=docs.schema["doc_id"].dataType.simpleString())
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"),
                       text_or_empty("text").alias("text"))
    arrow = to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, slots = [], []
            for t in batch.column(2):
                text = t.as_py()
                found = base_spans(text) if _HINT.search(text) else []
                base.append([{"start": s, "kind": k, "end": e} for s, e, k in found])
                slots.append([{"start": s, "end": e, "kind": k, "instance": i, "patterns": p}
                              for s, e, k, i, p in slots_of(text, found)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow.field(0).type), batch.column(1),
                 pa.array(base, arrow.field(2).type), pa.array(slots, arrow.field(3).type)], schema=arrow)
    return rows.mapInArrow(look, schema)


def bootstrap(slots: DataFrame, support: int = 3, confident: float = 0.5, accept: float = 0.75) -> DataFrame:
    """Slots (kind, instance, patterns) → newly known (instance, kind, score), until a round adds none.

    Every round's instances are a written table; a round without new ones ends the search, so their number is
    the longest chain of patterns and instances, whatever it is.
    """
    edges = stage(slots.select("instance", F.explode("patterns").alias("pattern")).distinct(), "pii-edges")
    seeds = stage(slots.groupBy("instance").agg(F.max("kind").alias("kind")).filter(F.col("kind") >= 0), "pii-seeds")
    found: list[DataFrame] = []
    known = seeds
    while True:
        marked = edges.join(known, "instance", "left")
        shares = [F.struct((F.sum((F.col("kind") == k).cast("int")) / F.count("*")).alias("share"),
                           F.sum((F.col("kind") == k).cast("int")).alias("n"),
                           F.lit(k).alias("kind")) for k in range(len(KINDS))]
        patterns = (marked.groupBy("pattern").agg(F.array_max(F.array(*shares)).alias("best"))
                    .filter((F.col("best.share") >= confident) & (F.col("best.n") >= support))
                    .select("pattern", F.col("best.kind").alias("kind"),
                            F.least("best.share", F.lit(0.999)).alias("confidence")))
        scored = (marked.filter(F.col("kind").isNull()).select("instance", "pattern")
                  .join(patterns, "pattern").groupBy("instance", "kind")
                  .agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("score"))
                  .groupBy("instance").agg(F.max(F.struct("score", -F.col("kind"))).alias("b"))
                  .select("instance", (-F.col("b.col2")).alias("kind"), F.col("b.score").alias("score"))
                  .filter(F.col("score") >= accept))
        scored = stage(scored, "pii-found")
        found.append(scored)
        if scored.isEmpty():
            break
        known = known.unionByName(scored.select("instance", "kind"))
    unstage(edges)
    unstage(seeds)
    return reduce(DataFrame.unionByName, found)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (base and found), n_found of every row."""
    seen = stage(scan(docs), "pii-scan")
    slots = seen.select("row", F.explode("slots").alias("s")).select("row", "s.*")
    found = bootstrap(slots.select("kind", "instance", "patterns"))
    added = (slots.filter(F.col("kind") < 0).select("row", "start", "end", "instance")
             .join(found.select("instance", "kind"), "instance")
             .groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added")))
    none = F.array().cast(f"array<{_SPAN}>")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return (seen.select("doc_id", "row", "base").join(added, "row", "left")
            .select("doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
                    F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                    _joined(F.array_sort(F.concat("base", F.coalesce("added", none)))).alias("spans"),
                    F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_found")))
