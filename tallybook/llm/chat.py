"""Chat formatting by event-sourced reconstruction (DataFrame functions only).

The input is an event log: conv_id, turn, msg, seq, kind, role, text. Kinds: ``open`` starts a
message (role, first text), ``delta`` appends, ``edit`` replaces the text so far, ``regenerate``
discards it and starts again, ``retract`` removes the message (a later ``open`` brings it back).

The log is dealt out once by (conversation, run of ``BLOCK`` turns). In there each message's events
are sorted by sequence and folded: what follows the last open, edit, regenerate or retract, joined.
The messages of a run are sorted by turn and rendered into one part; only rendered parts meet per
conversation, so a long conversation's events are never gathered in one task, only its text,
which is one value of the result anyway.

Template of a turn: ``### role: text</turn>`` and a line feed. Inside role and text a backslash is
written ``\\b``, ``### `` ``\\h`` and ``</turn>`` ``\\t``; in roles ``: `` is ``\\c``. After
escaping every backslash starts an escape and no control string is left, so :func:`read_back`
restores each turn exactly. Each part carries its loss mask as spans of code points over the text
of the ``assistant`` messages.

Rules: null role and text count as empty; a null turn comes first, a null seq before all; events
with equal seq order by kind, role and text; unknown kinds append; conversations with a null id
form one conversation; one whose messages are all retracted has no row. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 32
RESETS = ["open", "edit", "regenerate", "retract"]
END = "</turn>\n"
LOSS_ROLE = "assistant"


def escape(c: Column) -> Column:
    for plain, coded in (("\\", "\\b"), ("### ", "\\h"), ("</turn>", "\\t")):
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column) -> Column:
    for plain, coded in (("### ", "\\h"), ("</turn>", "\\t"), (": ", "\\c"), ("\\", "\\b")):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def _role(c: Column) -> Column:
    return F.replace(escape(c), F.lit(": "), F.lit("\\c"))


def fold(log: DataFrame) -> DataFrame:
    """Event log → final messages (conv_id, block, turn, msg, role, text)."""
    ev = F.col("ev")
    cut = F.array_max(F.transform(ev, lambda x, i: F.when(x["kind"].isin(RESETS), i).otherwise(-1)))
    live = F.slice(ev, F.greatest(F.col("cut"), F.lit(0)) + 1, F.size(ev))
    roles = F.filter(F.transform(ev, lambda x: x["role"]), lambda r: r.isNotNull())
    block = F.floor(F.coalesce(F.col("turn").cast("long"), F.lit(0)) / BLOCK).cast("long")
    return (log.select("conv_id", block.alias("block"), "turn", "msg", "seq", "kind", "role", "text")
            .repartition(F.col("conv_id"), F.col("block"))
            .groupBy("conv_id", "block", "turn", "msg")
            .agg(F.array_sort(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("ev"))
            .withColumn("cut", cut)
            .filter(~F.coalesce(F.get(ev, F.greatest(F.col("cut"), F.lit(0)))["kind"] == "retract",
                                F.lit(False)))
            .select("conv_id", "block", "turn", "msg",
                    F.coalesce(F.get(roles, F.size(roles) - 1), F.lit("")).alias("role"),
                    F.array_join(F.transform(live, lambda x: F.coalesce(x["text"], F.lit(""))), "")
                    .alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """Messages → one row per conversation: ``parts`` array of (block, text, loss spans)."""
    piece = F.transform("msgs", lambda m: F.struct(
        F.concat(F.lit("### "), _role(m["role"]), F.lit(": ")).alias("head"),
        escape(m["text"]).alias("body"), (m["role"] == LOSS_ROLE).alias("loss")))
    size = lambda p: F.length(p["head"]) + F.length(p["body"]) + len(END)
    spans = F.aggregate(
        "pieces", F.struct(F.lit(0).cast("int").alias("at"),
                           F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + size(p)).alias("at"),
            F.when(p["loss"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.length(p["head"])).alias("start"),
                F.length(p["body"]).alias("length"))))).otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    return (messages.groupBy("conv_id", "block")
            .agg(F.array_sort(F.collect_list(F.struct("turn", "msg", "role", "text"))).alias("msgs"))
            .select("conv_id", "block", piece.alias("pieces"))
            .select("conv_id", F.struct("block", text.alias("text"), spans.alias("loss")).alias("part"))
            .groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts")))


def format_chats(log: DataFrame) -> DataFrame:
    """Event log → conv_id, parts, formatted (the whole text, the parts joined)."""
    out = render(fold(log))
    return out.withColumn("formatted", F.array_join(F.transform("parts", lambda p: p["text"]), ""))


def read_back(formatted: DataFrame) -> DataFrame:
    """Formatted chats → conv_id, turns (role, text), loss (texts under the mask), all unescaped."""
    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, ": ", 1)
        n = F.length(head)
        return F.struct(unescape(F.substr(head, F.lit(5))).alias("role"),
                        unescape(F.substr(piece, n + 3)).alias("text"))

    def turns(text: Column) -> Column:
        pieces = F.split(text, END, -1)
        return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)
    return formatted.select(
        "conv_id", "formatted",
        F.flatten(F.transform("parts", lambda p: turns(p["text"]))).alias("turns"),
        F.flatten(F.transform("parts", lambda p: F.transform(p["loss"], lambda s: unescape(
            F.substr(p["text"], s["start"] + 1, s["length"]))))).alias("loss"))
