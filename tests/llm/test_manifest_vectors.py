import hashlib
import random

import numpy as np
import pytest
from brute import crc
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from odd_rows import no_docs, odd_docs  # noqa: F401
from tallybook.llm import merkle, part_codes, vector_links
from tallybook.llm.common import table


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes):
    """All levels of a tree over ``nodes``."""
    levels = [list(nodes)]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[k:k + 2]) for k in range(0, len(last), 2)])
    return levels


def plain_manifest(rows):
    """rows (doc_id, source, lang, n_chars, text) → sorted result rows of op11."""
    def leaf(r, more=0):
        r = [r[0], r[1], r[2], None if r[3] is None else r[3] + more, r[4]]
        return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in r])
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees, own = [], []
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        own.append(mine)
        trees.append(climb([leaf(r) for r in mine]))
    top = climb([t[-1][0] for t in trees]) if trees else []
    out = []
    for k, (mine, tree) in enumerate(zip(own, trees)):
        for pos, r in enumerate(mine):
            proof, shown = "", leaf(r, 1 if r[0] is not None and crc(r[0]) % 7 == 0 else 0)
            for levels, at in ((tree, pos), (top, k)):
                for level in levels[:-1]:
                    mate = at ^ 1
                    if mate >= len(level):
                        shown = H(shown)
                    else:
                        shown = H(level[mate], shown) if at & 1 else H(shown, level[mate])
                        proof += level[mate]
                    at >>= 1
            out.append((r[0], leaf(r), tree[-1][0], top[-1][0], H(proof), shown, shown == top[-1][0]))
    return sorted(out, key=repr)


def manifest_rows(docs, **kw):
    tampered = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0, F.lit(False))
    shown = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    got = merkle.manifest(docs, shown, **kw).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    return sorted(map(tuple, got), key=repr)


def plain_rows(docs):
    return plain_manifest([tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()])


@pytest.mark.parametrize("run", [1, 7, 64, 2048])
def test_manifest_of_documents(spark, run):
    docs = table(spark, SF_SMALL, "documents")
    got = manifest_rows(docs, run=run)
    assert got == plain_rows(docs)
    assert {v for *_, v in got} == {True, False}


def test_manifest_in_several_rounds(spark, monkeypatch):
    """More leaves than one group folds: trees of every shape, borders anywhere."""
    monkeypatch.setattr(merkle, "BITS", 2)
    rng = random.Random(4)
    sizes = {"a": 1, "b": 2, "c": 3, "d": 17, "é": 64, "z": 65, None: 130, "": 33}
    rows = [(rng.randrange(10 ** 6), "s", lang, rng.randrange(9), f"text {lang} {k}") for lang, n in sizes.items() for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for run in (5, 16):
        assert manifest_rows(docs, run=run) == plain_manifest(rows)


def test_manifest_odd_rows(odd_docs, no_docs):
    assert manifest_rows(odd_docs, run=3) == plain_rows(odd_docs)
    assert merkle.manifest(no_docs).count() == 0
    one = odd_docs.filter("doc_id = 1")
    (row,) = merkle.manifest(one).collect()
    assert row.root == row.subroot == row.leaf and row.verified and row.proof_sha256 == H("")


def test_octopus_states_few_nodes():
    """A partition of neighbours needs two nodes a level at most, whatever its number of leaves."""
    digests = [H(str(k)) for k in range(1000)]
    levels = climb(digests)
    lo, hi = 300, 699
    fetched = {(k, i): levels[k][i] for k in range(len(levels) - 1) for i in ((lo >> k) - 1, (hi >> k) + 1)
               if 0 <= i < len(levels[k]) and ((i == (lo >> k) - 1 and (lo >> k) % 2) or (i == (hi >> k) + 1 and (hi >> k) % 2 == 0))}
    octopus = merkle.Octopus(1000, lo, digests[lo:hi + 1], fetched)
    assert len(fetched) <= 2 * (len(levels) - 1)
    for pos in (lo, 301, 512, hi):
        assert merkle.refold(digests[pos], octopus.siblings(pos)) == levels[-1][0]


# ---------------------------------------------------------------- vector codes

def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """rows (vec_id, vector, label) → {vec_id: (code, error, label_error)} and the codebooks."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = [[r[1][p * w:p * w + w] for r in kept] for p in range(parts)]
    books = [[list(v) for v in own[:entries]] for own in cut]

    def nearest(v, book):
        d = [sum((a - b) ** 2 for a, b in zip(v, e)) for e in book]
        return min(range(len(book)), key=lambda k: (d[k], k)), min(d)
    for _ in range(rounds):
        for p in range(parts):
            own = [nearest(v, books[p])[0] for v in cut[p]]
            for e in range(len(books[p])):
                mine = [v for v, o in zip(cut[p], own) if o == e]
                if mine:
                    books[p][e] = [sum(col) // len(mine) for col in zip(*mine)]
    out, by_label = [], {}
    for k, (i, _, label) in enumerate(kept):
        both = [nearest(cut[p][k], books[p]) for p in range(parts)]
        error = sum(d for _, d in both)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for e, _ in both), error, label))
    return sorted(((i, c, e, by_label[l]) for i, c, e, l in out), key=repr), books


EMBEDDINGS = "vec_id long, embedding array<float>, label int, code string, node long"


def code_rows(df, **kw):
    codes, books = part_codes.compress(df, **kw)
    got = part_codes.with_label_error(codes).select("vec_id", "code", "error", "label_error").collect()
    return sorted(map(tuple, got), key=repr), [b.tolist() for b in books]


def test_codes_against_plain_rounds(spark):
    emb = table(spark, SF_SMALL, "embeddings")
    want, books = plain_codes([tuple(r) for r in emb.select("vec_id", "embedding", "label").limit(200).collect()])
    for block in (4096, 30):
        got, own = code_rows(emb.limit(200), block=block)
        assert (got, own) == (want, books)


def test_codes_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 16) / 4], int(i % 3) if i % 5 else None) for i in range(60)]
    rows += [(100, None, 1), (101, [float("nan")] + [0.0] * 15, 1), (102, [None] + [0.0] * 15, 1), (103, [float("inf")] * 16, 0),
             (5, rows[5][1], 2), (None, rows[7][1], None), (104, [0.0] * 16, 7), (104, [0.0] * 16, 7)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], EMBEDDINGS)
    want, books = plain_codes(rows)
    assert code_rows(df, block=16) == (want, books)
    few = rows[:3] + [(200, [1.0] * 4, 0)]                         # fewer rows than entries; another length
    assert code_rows(spark.createDataFrame([(*r, "x", 0) for r in few], EMBEDDINGS)) == plain_codes(few[:3])
    codes, _ = part_codes.compress(df.limit(0))
    assert codes.count() == 0


def test_anchor_trees_hold_every_point_once():
    rng = np.random.default_rng(1)
    for points in (rng.integers(-3000, 3000, (700, 8)), np.repeat(rng.integers(-5, 5, (9, 8)), 60, axis=0), np.zeros((50, 8), int),
                   np.concatenate([rng.integers(-3, 3, (500, 8)), rng.integers(-4000, 4000, (5, 8))])):
        tree = part_codes.grow(points, leaf=8)
        assert sorted(tree.order.tolist()) == list(range(len(points)))
        for k, (lo, hi, left, right) in enumerate(tree.balls):
            own = points[tree.order[lo:hi]]
            assert (tree.sums[k] == own.sum(axis=0)).all()
            assert np.sqrt(((own - own.mean(axis=0)) ** 2).sum(axis=1)).max() <= tree.radii[k] + 1e-6
            if left >= 0:
                assert [tree.balls[left][0], tree.balls[left][1], tree.balls[right][1]] == [lo, tree.balls[right][0], hi]
        book = np.concatenate([points[:12], points[:2]])            # with equal entries
        d2 = ((points[:, None] - book[None]) ** 2).sum(axis=2)
        entry, error = part_codes.assign(tree, book)
        assert (entry == d2.argmin(axis=1)).all() and (error == d2.min(axis=1)).all()
        sums, counts = part_codes.gather(tree, book)
        assert counts.tolist() == np.bincount(entry, minlength=len(book)).tolist()
        assert all((sums[e] == points[entry == e].sum(axis=0)).all() for e in range(len(book)))


def test_balls_are_owned_whole():
    """Far clusters: no point is compared one by one."""
    rng = np.random.default_rng(3)
    centres = rng.integers(-10 ** 5, 10 ** 5, (6, 8))
    points = np.concatenate([c + rng.integers(-50, 50, (200, 8)) for c in centres])
    assert {kind for kind, *_ in part_codes.walk(part_codes.grow(points), centres)} == {"balls"}


# ---------------------------------------------------------------- vector links

def plain_links(rows, limit=0.9):
    """rows (vec_id, vector) → sorted (vec_id, n_links, component_id, kept)."""
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if o else None for (_, v), o in zip(rows, ok)]
    n, up = len(rows), list(range(len(rows)))
    links = [0] * n

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(n):
        for b in range(a + 1, n):
            if ok[a] and ok[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= limit:
                links[a] += 1
                links[b] += 1
                up[top(b)] = top(a)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[top(k)] = min(low.get(top(k), i), i)
    return sorted(((i, links[k], low.get(top(k)), i == low.get(top(k))) for k, (i, _) in enumerate(rows)), key=repr)


def link_rows(df, **kw):
    got = vector_links.near_vectors(df, **kw).select("vec_id", "n_links", "component_id", "kept").collect()
    return sorted(map(tuple, got), key=repr)


def families(rng, groups, size, noise, width=32):
    """Vectors around random centres; cosines of a family lie near the limit."""
    out = []
    for _ in range(groups):
        c = rng.normal(size=width)
        for _ in range(size):
            out.append(c / np.linalg.norm(c) + rng.normal(size=width) * noise / np.sqrt(width))
    return np.array(out)


def test_links_odd_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.45]), (4, [0.0, 1.0]), (5, None), (6, [0.0, 0.0]), (7, [float("nan"), 1.0]),
            (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [1.0, 0.0]), (10, [1.0, 0.0]), (None, [0.0, 2.0]), (11, []), (12, [-0.0, 3.0]),
            (13, [1e-30, 0.0]), (14, [1e30, 0.0])]
    df = spark.createDataFrame([(i, v, 0, "x", 0) for i, v in rows], EMBEDDINGS)
    assert link_rows(df) == plain_links(rows)
    assert link_rows(df.limit(0)) == []


def test_links_against_all_pairs(spark, monkeypatch):
    """Small blocks, so that trees, chunks and pairs that meet in several blocks all occur."""
    monkeypatch.setattr(vector_links, "BLOCK", 40)
    monkeypatch.setattr(vector_links, "MOVED", 1)
    rng = np.random.default_rng(9)
    x = np.concatenate([families(rng, 40, 8, 0.35), families(rng, 2, 90, 0.2), rng.normal(size=(700, 32))]).astype(np.float32)
    rows = [(int(i), [float(c) for c in v]) for i, v in zip(rng.permutation(len(x)), x)]
    df = spark.createDataFrame([(i, v, 0, "x", 0) for i, v in rows], EMBEDDINGS)
    levels, trees = vector_links.plan(len(rows), 1.0, np.sqrt(0.2), 0.999)
    assert levels > 2 and trees > 2
    got, want = link_rows(df), plain_links(rows)
    missing = sum(w[1] for w in want) - sum(g[1] for g in got)
    assert all(g[1] <= w[1] for g, w in zip(got, want))              # no pair twice, none below the limit
    assert missing <= 0.003 * sum(w[1] for w in want)
    if missing == 0:
        assert got == want


def test_calibrated_windows():
    least = vector_links.calibrated_count(32, 2.0)
    p = 0.9544997
    assert vector_links.tail(32, p, least) >= 0.9999 > vector_links.tail(32, p, least + 1)
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(50, 8)), rng.normal(size=(60, 8))
    r, c = vector_links.collisions(a, b, 0.7, 5)
    want = {(i, j) for i in range(50) for j in range(60) if (np.abs(a[i] - b[j]) <= 0.7).sum() >= 5 and abs(a[i, 0] - b[j, 0]) <= 1e9}
    assert set(zip(r.tolist(), c.tolist())) <= want
    assert {(i, j) for i, j in want if abs(a[i, 0] - b[j, 0]) <= 0.7} <= set(zip(r.tolist(), c.tolist()))


def test_registered_with_sql():
    for name in ("op11_merkle_manifest", "op12_vector_codes", "op13_embedding_near_dup"):
        assert name in E.queries() and name in E.oracle_sql()
