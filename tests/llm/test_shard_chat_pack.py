import zlib

import numpy as np
import public_tokenizers
import pytest
from brute import sha
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as E
from odd_rows import no_docs, odd_docs  # noqa: F401
from conftest import SF_SMALL
from tallybook.llm import chat, packing, sharding
from tallybook.llm.common import table
from pyspark.sql import functions as F


def check_shards(rows, n_shards):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    sizes = [len(by.get(s, [])) for s in range(n_shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_sharding_rows_law(spark):
    got = E.queries()["op4_sharding"](spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in table(spark, SF_SMALL, "documents").collect()}
    check_shards(got, 16)
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


def test_sharding_odd_rows(odd_docs, no_docs):
    got = sharding.assign_shards(odd_docs, shards=4).collect()
    check_shards(got, 4)
    assert {(r.size, r.text_crc32) for r in got if r.doc_id in (4, 5)} == {(1, 0)}
    assert sharding.assign_shards(no_docs).count() == 0


def test_sharding_one_hot_id(spark):
    """All rows of one id, or of none, still fill every shard evenly."""
    docs = spark.createDataFrame([(7, f"t{k % 5}") for k in range(150)] + [(None, "x")] * 90, "doc_id long, text string")
    check_shards(sharding.assign_shards(docs, shards=7).collect(), 7)


def test_little_moves_when_a_shard_is_added():
    rng = np.random.default_rng(4)
    counts = {c: int(n) for c, n in enumerate(rng.integers(1, 4, 1 << 12))}

    def where(n):
        return {(r.cell, x): r.shard for r in sharding.lay_out({c << 4: v for c, v in counts.items()}, n, 64, 1.25).itertuples()
                for x in range(r.lo, r.hi)}
    old, new = where(16), where(17)
    moved = sum(old[k] != new[k] for k in old) / len(old)
    assert moved < 3 / 17


def test_bounded_loads_follow_the_ring():
    """Every cell goes to its home shard until that is full, then clockwise to the next with room."""
    rng = np.random.default_rng(2)
    counts = {int(c): int(n) for c, n in zip(rng.choice(1 << 16, 400, replace=False), rng.integers(1, 30, 400))}
    plan = sharding.lay_out(counts, 8, 16, 1.25)
    nodes = sharding.ring(8, 16)
    cap = -int(-1.25 * sum(counts.values()) // 8)
    used = plan.assign(n=plan.hi - plan.lo).groupby("shard").n.sum()
    assert used.max() <= cap and used.sum() == sum(counts.values())
    full = {s for s in range(8) if used.get(s, 0) == cap}
    for cell, own in plan.groupby("cell"):
        at = next((k for k, (c, _) in enumerate(nodes) if c >= cell), 0)
        order = list(dict.fromkeys(nodes[(at + k) % len(nodes)][1] for k in range(len(nodes))))
        assert sorted(x for a, b in zip(own.lo, own.hi) for x in range(a, b)) == list(range(counts[cell]))
        last = max(order.index(s) for s in own.shard)
        assert all(s in full for s in order[:last])
    moved = sum(n for (c, n) in counts.items()) - sum(
        r.hi - r.lo for r in plan.itertuples() if nodes[next((k for k, (c, _) in enumerate(nodes)
                                                              if c >= r.cell), 0)][1] == r.shard)
    assert moved < 0.2 * sum(counts.values())


LOG = "conv_id long, turn long, msg long, seq long, kind string, role string, text string"


def read(spark, events):
    out = chat.read_back(chat.format_chats(spark.createDataFrame(events, LOG))).collect()
    return {r.conv_id: ([(t.role, t.text) for t in r.turns], list(r.loss), r.formatted) for r in out}


def test_chat_folds_events(spark):
    events = [
        (1, 0, 1, 0, "open", "user", "he"), (1, 0, 1, 2, "delta", None, "o"), (1, 0, 1, 1, "delta", None, "ll"),
        (1, 1, 2, 9, "open", "assistant", ""), (1, 1, 2, 10, "delta", None, "draft"),
        (1, 1, 2, 11, "regenerate", None, None), (1, 1, 2, 12, "delta", None, "final "), (1, 1, 2, 13, "delta", None, "one"),
        (1, 2, 3, 20, "open", "user", "typo"), (1, 2, 3, 21, "edit", None, "fixed"),
        (1, 3, 4, 30, "open", "user", "gone"), (1, 3, 4, 31, "retract", None, None),
        (2, None, 5, None, None, None, None), (None, 0, 6, 0, "open", "assistant", "x</turn>\n### user: \\h\\"),
        (3, 0, 7, 0, "open", "a: b### \\c", ": "), (3, 0, 7, 0, "delta", None, None),
        (4, 0, 8, 0, "open", "user", "all"), (4, 0, 8, 1, "retract", None, None)]
    got = read(spark, events)
    assert got[1][0] == [("user", "hello"), ("assistant", "final one"), ("user", "fixed")]
    assert got[1][1] == ["final one"] and "### assistant: final one</turn>\n" in got[1][2]
    assert got[2][0] == [("", "")] and got[2][1] == []
    assert got[None][0] == [("assistant", "x</turn>\n### user: \\h\\")] and got[None][1] == [got[None][0][0][1]]
    assert got[3][0] == [("a: b### \\c", ": ")] and 4 not in got
    assert chat.format_chats(spark.createDataFrame([], LOG)).count() == 0


def test_chat_round_trip_of_control_strings(spark):
    """Texts built from the template's own pieces, long conversations over several blocks."""
    bits = ["### ", "</turn>", "\\", "\\h", "\\t", "\\b", "\\c", ": ", "\n", "", "é🙂", "###", "</turn", "<", "assistant"]
    rng = np.random.default_rng(4)
    rows = [(c, t, "".join(rng.choice(bits, rng.integers(0, 7))), "".join(rng.choice(bits, 3)))
            for c in range(6) for t in range(70)]
    events = [(c, t, c * 100 + t, t, "open", "assistant" if t % 2 else role, text) for c, t, text, role in rows]
    got = read(spark, events)
    for c in range(6):
        want = [(("assistant" if t % 2 else role), text) for k, t, text, role in rows if k == c]
        assert got[c][0] == want and got[c][1] == [x for r, x in want if r == "assistant"]


def test_chat_planted_conversation(spark):
    got = {r.conv_id: r for r in E.queries()["op5_chat_format"](spark, SF_SMALL).collect()}
    said = "\\### Assistant: </turn> ok"
    assert got[-7].turns_sha256 == sha(f"user\n{said}\nassistant\n{said}\n")
    assert (got[-7].loss_sha256, got[-7].loss_chars, got[-7].n_turns) == (sha(said), len(said), 2)


VOCAB = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(VOCAB)


@pytest.fixture(scope="module")
def word_ids():
    return packing.WordIds(VOCAB, most=50)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abZÉéß 'st\n\t.!19²½ΣİﬁÀ\x1c <|>日́")) | st.characters(codec="utf-8"), max_size=30)
                | st.sampled_from(["<|endoftext|>", "<|startoftext|>", " <|endoftext|>", "<|ENDOFTEXT|>"]),
                max_size=5).map("".join))
def test_word_ids_equal_the_tokenizer(text):
    t = Tokenizer.from_file(VOCAB) if not hasattr(test_word_ids_equal_the_tokenizer, "t") else test_word_ids_equal_the_tokenizer.t
    test_word_ids_equal_the_tokenizer.t = t
    w = getattr(test_word_ids_equal_the_tokenizer, "w", None) or packing.WordIds(VOCAB, most=50)
    test_word_ids_equal_the_tokenizer.w = w
    assert np.frombuffer(w.ids(text), np.uint32).tolist() == t.encode(text, add_special_tokens=False).ids


def check_pieces(rows, texts, tok, most=64):
    ids = {i: np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in texts.items()}
    by_doc, by_seq = {}, {}
    for r in rows:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length])
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(ids)
    for pieces, size in [(by_doc[i], len(ids[i])) for i in ids] + [(v, None) for v in by_seq.values()]:
        at = 0
        for start, length in sorted(pieces):
            assert start == at and length > 0
            at += length
        assert at == size if size else at <= 2048
    assert max(map(len, by_seq.values())) <= most
    return sum(map(len, ids.values())) / (2048 * len(by_seq))


def test_packing_covers_every_id(spark, tok):
    docs = table(spark, SF_SMALL, "documents")
    share = check_pieces(E.queries()["op9_packing"](spark, SF_SMALL).collect(),
                         {r.doc_id: r.text for r in docs.collect()}, tok)
    assert share > 0.97


def test_packing_odd_rows(odd_docs, no_docs, tok):
    rows = odd_docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    check_pieces(packing.pack_documents(rows, VOCAB, run_tokens=500).collect(),
                 {r.doc_id: r.text for r in rows.collect()}, tok)
    assert packing.pack_documents(odd_docs, VOCAB).agg(F.sum("length")).first()[0] > 0
    assert packing.pack_documents(no_docs, VOCAB).count() == 0


@pytest.mark.parametrize("cut", [False, True])
def test_pack_vectors_limits(cut):
    rng = np.random.default_rng(6)
    tokens = rng.integers(1, 900, 500)
    loss = tokens if cut else np.minimum((tokens * rng.random(500)).astype(int), 600)
    items = np.stack([tokens, np.ones(500, int), loss], axis=1)
    limits = np.array([1000, 5, 600 if not cut else 1000])
    bins = packing.pack_vectors(items, limits, cut)
    got = np.zeros(500, int)
    for own in bins:
        assert len(own) <= 5 and sum(n for _, _, n in own) <= 1000
        if not cut:
            assert sum(items[i, 2] for i, _, _ in own) <= 600
        for i, _, n in own:
            got[i] += n
    assert (got == tokens).all()
    assert len(bins) < 1.15 * max(tokens.sum() / 1000, loss.sum() / limits[2], 100)


def test_pack_vectors_refuses_what_fits_nowhere():
    for cut in (False, True):
        with pytest.raises(ValueError):
            packing.pack_vectors(np.array([[10, 1, 700], [5, 1, 5]]), np.array([1000, 5, 600]), cut)


def test_added_tokens_are_one_id(spark, tok):
    texts = {1: "before <|endoftext|>after", 2: "<|startoftext|><|endoftext|>", 3: "<|ENDOFTEXT|> is plain"}
    rows = packing.pack_documents(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), VOCAB).collect()
    check_pieces(rows, texts, tok)
    assert {r.doc_tokens for r in rows if r.doc_id == 2} == {3}


def test_many_words_outgrow_the_table(tok):
    w = packing.WordIds(VOCAB, most=20)
    texts = [" ".join(f"wörd{i}x{j}" for j in range(30)) for i in range(4)]
    import pyarrow as pa
    ids, starts = w.gather(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_pack_examples_under_three_limits(spark):
    rng = np.random.default_rng(8)
    rows = [(i, int(n), int(n * f)) for i, (n, f) in enumerate(zip(rng.integers(1, 700, 600), rng.random(600)))]
    rows += [(1000, 3000, 10), (1001, 900, 901), (1002, None, 5), (1003, 50, None), (1004, 0, 0)]
    got = packing.pack_examples(spark.createDataFrame(rows, "example_id long, tokens long, loss_tokens long"), 1000, 6, 400).collect()
    assert sorted((r.example_id, r.tokens, r.loss_tokens) for r in got if r.example_id != 1003 and r.example_id != 1002) == \
        sorted(r for r in rows if r[0] not in (1002, 1003))
    by = {}
    for r in got:
        fits = r.tokens is not None and r.tokens <= 1000 and (r.loss_tokens or 0) <= 400
        assert (r.sequence_id is not None) == fits
        if fits:
            by.setdefault(r.sequence_id, []).append(r)
    for own in by.values():
        assert len(own) <= 6 and sum(r.loss_tokens or 0 for r in own) <= 400
        at = 0
        for r in sorted(own, key=lambda r: (r.offset, r.tokens)):
            assert r.offset == at
            at += r.tokens
        assert at <= 1000
    assert any(sum(r.loss_tokens or 0 for r in own) > 350 for own in by.values())   # the loss limit binds
