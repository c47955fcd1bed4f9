import random

import numpy as np
import pytest
from brute import lower_az, near_components, sha, shingles

import __spark_entry__ as E
from odd_rows import no_docs, odd_docs  # noqa: F401
from conftest import SF_MID, SF_SMALL
from tallybook.llm import near_dup
from tallybook.llm.common import ROW, table, with_rows, without
from tallybook.llm.components import connected_components
from tallybook.llm.exact_dedup import drop_exact_copies, exact_dedup, resolve
from pyspark.sql import functions as F


def test_exact_dedup_rules(odd_docs):
    got = {}
    for r in exact_dedup(odd_docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert [r.keep_id for i in (1, 2, 3) for r in got[i]] == [3, 3, 3, 3]
    assert [r.group_size for r in got[1]] == [4]
    assert sum(r.kept for r in got[3]) == 1 and not got[1][0].kept
    assert got[4][0].keep_id == got[5][0].keep_id == 5          # null and empty texts are equal
    assert {r.keep_id for r in got[None]} == {None, 5}
    assert got[9][0].text_sha256 == sha(lower_az("ÉCOLE É école")) and got[9][0].kept and got[10][0].kept
    assert sum(r.kept for rs in got.values() for r in rs) == 9


def test_exact_dedup_empty_and_smallest(odd_docs, no_docs):
    assert exact_dedup(no_docs).count() == 0
    keep = {r.keep_id for r in exact_dedup(odd_docs.filter("doc_id < 4"), keep="smallest").collect()}
    assert keep == {1}
    left = drop_exact_copies(odd_docs)
    assert left.columns == odd_docs.columns and left.count() == 9


def test_exact_dedup_many_runs(spark):
    """Several merge rounds and a text held by a third of all rows."""
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("t"), F.col("id") % 500)).alias("text"))
    e = rows.select("doc_id", F.col("doc_id").alias("row"), (F.col("doc_id") % 300).cast("int").alias("run"),
                    F.unhex(F.sha2("text", 256)).alias("digest"), F.xxhash64("text").alias("check"),
                    F.octet_length("text").alias("n_bytes"))
    got = resolve(e, fan_in=4)
    want = {r.t: (r.k, r.n) for r in rows.groupBy(F.sha2("text", 256).alias("t"))
            .agg(F.max("doc_id").alias("k"), F.count("*").alias("n")).collect()}
    out = got.select(F.lower(F.hex("digest")).alias("t"), "keep_id", "n").collect()
    assert len(out) == 3000 and all(want[r.t] == (r.keep_id, r.n) for r in out)


def test_exact_dedup_text_ids(spark):
    rows = [("b", "x"), ("a", "X"), ("c", "y"), (None, "x"), ("a", "x"), (None, "z")]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    for keep, want in (("largest", "b"), ("smallest", "a")):
        got = exact_dedup(docs, keep=keep).collect()
        assert {r.keep_id for r in got if r.group_size == 4} == {want}
        assert sorted((r.doc_id or "", r.group_size) for r in got if r.kept) == sorted(((want, 4), ("c", 1), ("", 1)))
    assert drop_exact_copies(docs).count() == 3


def test_near_dup_repeated_ids(spark):
    """Rows of one id with different texts, and the same row many times."""
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(1, text + f" t{k}") for k in range(20)] + [(1, text)] * 20 + [(2, "alone here with words")] * 3 + [(3, text)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()
    assert len(got) == len(rows) and sum(r.kept for r in got) == 2
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 2), (3, 1)}


def test_links_between_sets():
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 10 ** 6, 60)).astype(np.int64)

    def edit(n):
        keep = rng.permutation(base)[n:]
        return np.sort(np.concatenate([keep, rng.integers(10 ** 6, 10 ** 7, n)]))
    left, right = [edit(n) for n in (0, 3, 9, 20)], [edit(n) for n in (1, 2, 8, 30, 4)]
    near = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
    found = near_dup.links_between(left, right, np.arange(4), np.arange(10, 15), 80)
    up = {x: x for x in [*range(4), *range(10, 15)]}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in found:
        assert near(left[a], right[b]) and top(a) != top(b + 10)
        up[top(b + 10)] = top(a)
    assert all(top(a) == top(b + 10) for a in range(4) for b in range(5) if near(left[a], right[b]))
    same = near_dup.links_between(left, None, np.zeros(4, int), np.zeros(4, int), 80)
    assert same == []


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1060)]
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "src long, dst long")).collect()}
    assert got == {x: top(x) for a, b in links if a != b for x in (a, b)}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_near_dup_against_all_pairs(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text").collect()
    want, sizes = near_components([(r.doc_id, r.text) for r in docs], 2)
    got = E.queries()["op10_near_dup"](spark, sf).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_dup_families(spark):
    """Families around the limit, where a hub does not link to all: chains must still be found."""
    rng = random.Random(5)
    rows, k = [], 0
    for fam in range(6):
        base = [f"w{rng.randrange(9999)}" for _ in range(60)]
        for _ in range(25):
            w = list(base)
            for _ in range(rng.randrange(6)):
                w[rng.randrange(60)] = f"x{rng.randrange(9999)}"
            rows.append((k, " ".join(w)))
            k += 1
    want, _ = near_components(rows, 2)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert len(set(want.values())) > 6


def test_near_dup_rules(odd_docs, no_docs):
    got = {(r.doc_id, r[ROW]): r for r in near_dup.near_duplicates(odd_docs, shingle=2).collect()}
    by = {}
    for (i, _), r in got.items():
        by.setdefault(i, []).append(r)
    assert len(got) == 14
    assert {r.component_id for i in (1, 2, 3) for r in by[i]} == {1}
    assert by[4][0].component_id == 4 and by[5][0].component_id == 5 and by[8][0].component_id == 8
    assert by[4][0].n_shingles == 0 and by[4][0].kept
    assert [r.component_id for r in by[None]] == [None, None] and all(r.kept for r in by[None])
    assert by[7][0].component_id == 6 and not by[7][0].kept
    assert near_dup.near_duplicates(no_docs).count() == 0
    left = near_dup.drop_near_copies(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 0, 1, 4, 5, 6, 8, 9, 10, 11]


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2 ** 63, 4000).astype(np.uint64)
    both = np.concatenate([a[:3000], rng.integers(0, 2 ** 63, 1000).astype(np.uint64)])
    ra, rb, union = near_dup.registers([a, both, np.unique(np.concatenate([a, both]))], 512)
    assert (np.maximum(ra, rb) == union).all()                     # sketches merge by maximum
    j = near_dup.likely_similarity(np.array([(ra < rb).sum()]), np.array([(ra > rb).sum()]), 512,
                                   np.array([4000.0]), np.array([4000.0]))[0]
    assert abs(j - 0.6) < 0.1                                      # 3000 of 5000 shared
    assert (near_dup.registers([np.zeros(0, np.uint64)], 8) == 0).all()


def test_shingle_sets_match_words():
    for text in ("", None, "one", "A b\x0bC\x1cd é", "x y x y x y", "Ä ä Z z"):
        for size in (1, 2, 5):
            assert len(near_dup.shingle_set(text, size, near_dup._WordHashes())) == len(shingles(text, size))


def test_with_rows_numbers_each_row(odd_docs):
    rows = with_rows(odd_docs, "t")
    few = rows.filter("doc_id = 3").select(ROW)
    for most in (0, 100):                    # joined by shuffle, broadcast
        left = without(rows, few, most)
        assert left.columns == odd_docs.columns and left.count() == 12 and left.filter("doc_id = 3").count() == 0
    assert rows.select(ROW).distinct().count() == 14
