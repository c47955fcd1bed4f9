import math
import random
from collections import Counter

import numpy as np
from brute import BASE, crc, personal_data, sha
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from odd_rows import no_docs, odd_docs  # noqa: F401
from conftest import SF_MID, SF_SMALL
from tallybook.llm import decontaminate, html_main, langid, pii, quality
from tallybook.llm.common import table


# ---- quality --------------------------------------------------------------------------------
def test_quality_held_out_accuracy(spark):
    got = E.queries()["op1_quality"](spark, SF_MID).collect()
    labels = {r.doc_id: r.quality for r in table(spark, SF_MID, "labels").collect()}
    assert len(got) == 1000 and all(r.held_out == (crc(r.doc_id) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    test = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in test]) >= 0.93


def test_flattened_trees_walk_like_nodes():
    rng = np.random.default_rng(0)
    x = rng.random((400, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    model = quality.grow(x, y, trees=20, depth=3)
    want = []
    for row in x:
        total = model.base
        for f, c, v in zip(model.feature, model.limit, model.leaf, strict=True):
            k = 0
            while k < len(f):
                k = 2 * k + 2 if row[f[k]] > c[k] else 2 * k + 1
            total += v[k - len(f)]
        want.append(1 / (1 + math.exp(-total)))
    assert np.allclose(model.score(x), want) and np.mean((model.score(x) > 0.5) == y) > 0.97


@settings(max_examples=80, deadline=None)
@given(st.text(st.sampled_from(list("aB1 #!|.,;:?\n\t$é_")), max_size=120))
def test_statistics_by_hand(text):
    raw = text.encode()
    got = dict(zip(quality.STATS, quality.statistics(text), strict=True))
    words, n = text.replace("\t", " ").replace("\n", " ").split(" "), max(1, len(raw))
    words = [w.encode() for w in words if w]
    lines = [x for x in text.split("\n") if x.strip()]
    m = max(1, len(words))
    want = {"log_bytes": math.log(len(raw) + 1), "log_words": math.log(len(words) + 1), "word_len": sum(map(len, words)) / m,
            "upper": sum(65 <= b <= 90 for b in raw) / n, "digit": sum(48 <= b <= 57 for b in raw) / n,
            "exclaim": raw.count(b"!") / n, "bar": raw.count(b"|") / n, "mark": sum(raw.count(x) for x in (b",", b";", b":")) / n,
            "stop": (raw.count(b".") + raw.count(b"?")) / n, "distinct": len(set(words)) / m,
            "top_word": max([words.count(w) for w in words], default=0) / m,
            "repeat_next": sum(a == b for a, b in zip(words, words[1:])) / m,
            "distinct_pairs": len({(a, b) for a, b in zip(words, words[1:])}) / m, "lines": math.log(len(lines) + 1),
            "distinct_lines": len(set(lines)) / max(1, len(lines)),
            "short_lines": sum(len(x.encode()) < 30 for x in lines) / max(1, len(lines))}
    assert all(abs(got[k] - v) < 1e-9 for k, v in want.items())


def test_histogram_split_is_the_best_of_all():
    """A stump's cut has the largest gain among all statistics and all edges, tried one by one."""
    rng = np.random.default_rng(6)
    for seed in range(5):
        x = np.round(rng.random((200, 4)), 2)
        y = (x[:, seed % 4] + 0.3 * rng.random(200) > 0.7).astype(float)
        model = quality.grow(x, y, trees=1, depth=1, bins=16)
        p = 1 / (1 + math.exp(-model.base))
        grad, hess = p - y, np.full(200, p * (1 - p))

        def gain(j, limit):
            left = x[:, j] <= limit
            if hess[left].sum() < 4 or hess[~left].sum() < 4:
                return 0.0
            part = lambda m: grad[m].sum() ** 2 / (hess[m].sum() + 1)
            return part(left) + part(~left) - part(np.ones(200, bool))
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 17)[1:-1])) for j in range(4)]
        best = max(gain(j, e) for j in range(4) for e in edges[j])
        assert best > 0 and abs(gain(model.feature[0, 0], model.limit[0, 0]) - best) < 1e-9
        left = x[:, model.feature[0, 0]] <= model.limit[0, 0]
        for side, value in ((left, model.leaf[0, 0]), (~left, model.leaf[0, 1])):
            assert abs(value + 0.15 * grad[side].sum() / (hess[side].sum() + 1)) < 1e-9


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 0), (3, None, 0), (None, 1, 0), (6, 0, 1), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    model = quality.train(odd_docs, labels)
    got = quality.score_documents(odd_docs, model).collect()
    assert len(got) == 14 and all(0 <= r.score <= 1 for r in got)
    assert quality.score_documents(no_docs, model).count() == 0
    none = quality.train(odd_docs, labels.limit(0))
    assert {r.predicted for r in quality.score_documents(odd_docs, none).collect()} == {1}
    assert quality.statistics(None) == quality.statistics("")


# ---- decontamination ------------------------------------------------------------------------
def test_contamination_against_plain_search(spark):
    docs = [(r.doc_id, decontaminate.words_of(r.text)) for r in table(spark, SF_MID, "documents").collect()]
    items = [(r.item_id, decontaminate.words_of(r.text)) for r in table(spark, SF_MID, "benchmark").collect()]
    want = set()
    for d, w in docs:
        text = " " + " ".join(w) + " "
        want |= {(d, i) for i, q in items if " " + " ".join(q) + " " in text}
    got = {(r.doc_id, r.item_id) for r in E.queries()["op2_decontaminate"](spark, SF_MID).collect()}
    assert want and got == want


def test_block_max_wand_retrieves_all():
    rng = random.Random(8)
    vocab = [f"t{int(rng.paretovariate(0.8))}" for _ in range(4000)]
    items = [(k, [rng.choice(vocab) for _ in range(rng.randrange(5, 90))], []) for k in range(120)]
    ix = decontaminate.Index(items, block=4)
    weight = {}
    for t, docs in enumerate(ix.docs):
        for d, w in zip(docs, ix.impact[t], strict=True):
            weight[t, d] = w
    for _ in range(60):
        query = sorted({ix.terms[w] for w in rng.choices(vocab, k=40) if w in ix.terms})
        for least in (0.05, 0.3, 0.7):
            want = {d: sum(weight.get((t, d), 0) for t in query) for d in range(len(ix.item_of))}
            got = dict(ix.retrieve(query, least))
            assert set(got) == {d for d, s in want.items() if s >= least}
            assert all(abs(got[d] - want[d]) < 1e-9 for d in got)
            n = len(query)
            live = ix.live(np.zeros(n, np.int64), np.array(query), 1, least)
            assert not got or len(live) == 1


def test_contamination_rules(spark, odd_docs, no_docs):
    item = "a quick brown fox jumps over the lazy dog near the river bank today and then sleeps"
    other = "Answer: forty two apples in a basket by the door"
    bench = spark.createDataFrame([(1, item, None), (2, None, None), (3, "too short", None), (4, "What is there", other)],
                                  "item_id long, text string, answer string")
    docs = spark.createDataFrame([
        (1, "lead " * 500 + item.upper().replace(" ", ", ") + " tail" * 500), (2, item[:40]), (3, None), (4, ""),
        (5, "What is there? " + other), (6, "What is there?"), (7, other), (1, item)], "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.find_contamination(docs, bench).collect())
    assert got == [(1, 1), (1, 1), (5, 4)]
    assert decontaminate.find_contamination(docs, bench.limit(0)).count() == 0
    assert decontaminate.find_contamination(no_docs, bench).count() == 0
    left = decontaminate.drop_contaminated(odd_docs, bench)
    assert left.columns == odd_docs.columns and left.count() == 14
    split = [decontaminate.searchers(x) for x in decontaminate.item_parts(bench, index_chars=60)]
    assert len(split) > 1 and sum(len(ix.items) for x in split for ix in x if isinstance(ix, decontaminate.Index)) == 2
    parted = decontaminate.find_contamination(docs, bench, index_chars=60)
    assert sorted((r.doc_id, r.item_id) for r in parted.collect()) == got
    assert decontaminate.drop_contaminated(docs, bench, index_chars=60).count() == 5


def test_contamination_by_excerpts_and_short_items(spark):
    words = [f"w{k}x" for k in range(300)]
    item, long, wide = words[:59], words[60:260], " ".join(words[260:])
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(long)), (3, "Too short!"), (4, wide), (5, "?!")],
                                  "item_id long, text string")
    rest = "other text around the excerpt " * 40
    texts = {1: item[:40], 2: item[-30:], 3: item[:12], 4: long[50:150], 5: ["it", "is", "too", "SHORT,", "yes"],
             6: ["too", "very", "short"], 7: wide.split()[::-1], 8: ["too"]}
    docs = spark.createDataFrame([(k, rest + " ".join(x) + ". " + rest) for k, x in texts.items()], "doc_id long, text string")
    got = decontaminate.find_contamination(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 1), (2, 1), (4, 2), (5, 3)]
    assert all(r.question_overlap == 1 and r.answer_overlap is None for r in got)
    asked = spark.createDataFrame([(1, " ".join(item), "one two three four five six"), (2, "Who?", "Me too"), (3, None, "w1x w2x")],
                                  "item_id long, text string, answer string")
    texts = {1: item, 2: [*item, "one two three four five six"], 3: ["who", "me", "too"], 4: ["who", "too", "me"], 5: ["w1x w2x"]}
    docs = spark.createDataFrame([(k, " ".join(x)) for k, x in texts.items()], "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.find_contamination(docs, asked).collect())
    assert got == [(1, 3), (2, 1), (2, 3), (3, 2), (5, 3)]


def test_excerpts_of_a_segments_length_are_found(spark):
    """Recall of excerpts of 32 words and more, wherever they start and wherever they stand."""
    rng = random.Random(12)
    items = [(r.item_id, decontaminate.words_of(r.text)) for r in table(spark, SF_MID, "benchmark").collect()]
    items += [(10_000 + k, [f"v{rng.randrange(3000)}" for _ in range(n)]) for k, n in enumerate((33, 40, 48, 63, 64, 65, 90, 200))]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    rows, want = [], set()
    for i, w in items:
        for n in (32, 45):
            if len(w) > n:
                at = rng.randrange(len(w) - n + 1)
                lead = [f"u{rng.randrange(5000)}" for _ in range(rng.randrange(90))]
                want.add((len(rows), i))
                rows.append((len(rows), " ".join(lead + w[at:at + n] + [f"u{rng.randrange(5000)}" for _ in range(50)])))
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_contamination(
        spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()}
    assert len(want) > 10 and len(want & got) >= 0.9 * len(want)
    for n in (0, 1, 32, 33, 47, 64, 100):
        parts = decontaminate.segments_of(list(range(n)))
        assert all(0 < len(p) <= 32 for p in parts) and {x for p in parts for x in p} == set(range(n))


# ---- personal data --------------------------------------------------------------------------
def spans(text):
    return ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in personal_data(text))


def test_base_spans_of_documents(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF_MID, "documents").collect()}
    got = E.queries()["op6_pii"](spark, SF_MID).collect()
    assert len(got) == len(texts)
    for r in got:
        want = spans(texts[r.doc_id])
        assert r.base_sha256 == sha(want)
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
        kinds = Counter(x.split(":")[0] for x in want.split(",") if x)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds[k] for k in BASE]


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from(list("a.Z@-+ 01259()%\n_é")), max_size=80))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == [(s, e, k) for s, k, e, _ in personal_data(text)]


def test_contexts_find_unseen_identifiers(spark, no_docs):
    rows = [(i, f"please write to mail a{i}@b.com today {i}") for i in range(8)]
    rows += [(20 + i, f"please write to mail user{i}000(at)host today") for i in range(2)]
    rows += [(40, "the code x12345 stays"), (41, None), (42, "")]
    got = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    at = rows[8][1].index("user0")
    assert got[20].spans == f"email:{at}:{at + len('user0000(at)host')}" and got[20].n_email == 0
    assert got[20].base_sha256 == sha("") and got[20].n_found == 1
    assert got[0].spans == spans(rows[0][1]) and got[40].spans == "" and got[41].spans == got[42].spans == ""
    assert pii.find_personal_data(no_docs).count() == 0


def test_personal_data_odd_rows(odd_docs):
    assert pii.find_personal_data(odd_docs).count() == 14


# ---- language -------------------------------------------------------------------------------
def test_language_held_out_accuracy(spark):
    got = E.queries()["op7_language"](spark, SF_MID).collect()
    langs = {r.doc_id: r.lang for r in table(spark, SF_MID, "documents").collect()}
    assert all(r.held_out == (crc(r.doc_id) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    test = [r for r in got if r.held_out]
    assert len(got) == 1000 and np.mean([r.lang_pred == langs[r.doc_id] for r in test]) >= 0.97
    assert np.mean([r.accepted for r in test]) > 0.9


def test_kneser_ney_by_hand():
    """Every order's interpolated probability against a dictionary version."""
    text = "the cat sat on the mat and the hat that the cat had"
    keys, _, _ = langid.windows([text])
    uniq, n = np.unique(keys, return_counts=True)
    model = langid.Model(uniq, n)
    grams = Counter()
    for k in keys.tolist():
        grams[tuple((k >> s) & 0xFFFF for s in (48, 32, 16, 0))] += 1
    counts = [None, None, None, None, dict(grams)]
    for size in (3, 2, 1):
        higher = counts[size + 1]
        counts[size] = Counter(g[1:] for g in higher)

    def prob(g):
        if not g:
            return 1 / (len(counts[1]) + 1)
        c = counts[len(g)]
        ones, twos = (sum(v == x for v in c.values()) for x in (1, 2))
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        same = {k: v for k, v in c.items() if k[:-1] == g[:-1]}
        if not same:
            return prob(g[1:])
        return (max(c.get(g, 0) - d, 0) + d * len(same) * prob(g[1:])) / sum(same.values())
    tests = [*grams, (1, 1, 1, 113), (116, 104, 101, 113), (113, 113, 113, 113)]
    packed = np.array([g[0] << 48 | g[1] << 32 | g[2] << 16 | g[3] for g in tests], np.uint64)
    assert np.allclose(model.prob(packed), [prob(g) for g in tests])


def test_language_rules(spark, odd_docs, no_docs):
    rows = [(i, t, x) for i, (t, x) in enumerate([("the house and the garden " * 5, "en"), ("das haus und der garten " * 5, "de")] * 30)]
    models = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert models.names == ["de", "en"]
    got = {r.doc_id: r for r in langid.identify(odd_docs.filter("doc_id is not null"), models).collect()}
    assert got[4].lang_pred == got[5].lang_pred == got[8].lang_pred == got[11].lang_pred == "und"
    assert got[4].score == 0 and got[1].lang_pred in ("de", "en")
    far = langid.identify(spark.createDataFrame([(1, "zxq wvk jjj 🙂𝒳 qqq zzz xxx", "")], "doc_id long, text string, z string"), models)
    assert [r.accepted for r in far.collect()] == [False]
    assert langid.identify(no_docs, models).count() == 0
    none = langid.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in langid.identify(odd_docs, none).collect()} == {"und"}


def test_language_models_keep_every_window(spark):
    """More than two million distinct windows, nearly all seen once, and two common ones."""
    rng = np.random.default_rng(3)
    letters = rng.integers(0x4E00, 0x9FA0, (60, 45_000)).astype("<u4")
    rows = spark.createDataFrame(
        [(i, x.tobytes().decode("utf-32-le") + " same" * 9, "zh" if i % 2 else "ja") for i, x in enumerate(letters)],
        "doc_id long, text string, lang string")
    models = langid.train(rows)
    learned = rows.filter("pmod(xxhash64(doc_id, lang), 20) != 0").collect()
    for name, model in zip(models.names, models.models, strict=True):
        keys, _, _ = langid.windows([r.text for r in learned if r.lang == name])
        want = langid.Model(*np.unique(keys, return_counts=True))
        for got, own in zip(model.orders, want.orders, strict=True):
            assert np.array_equal(got.keys, own.keys) and np.array_equal(got.n, own.n)
            assert got.discount == own.discount
    assert sum(len(m.orders[0].keys) for m in models.models) > 2_000_000


# ---- pages ----------------------------------------------------------------------------------
def test_generated_pages(spark):
    """The test pages hold their article in <article>: plain extraction by that tag must agree."""
    import html
    import re
    pages = {r.page_id: r.html for r in table(spark, SF_SMALL, "pages").collect()}
    got = E.queries()["op8_html_text"](spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[a-z/][^>]*>", "", b.replace("<br>", " "))).split())
                  for b in re.split(r"</?(?:p|h1)>", body)]
        want = "\n".join(b for b in blocks if b)
        assert r.text == want and r.n_chars == len(want)


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>no";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><div class="cookie-notice">We use cookies</div>
<div class="wrap"><div class="post-{n} entry"><h2>Head &amp; line</h2><p>First   para&nbsp;graph<br>goes <b>on</b> <a href=x>here</a>.
<p>Second &lt;b&gt; one<ul><li>item a<li>item b</ul><!-- <p>hidden</p> --><div class='ads'>Buy now</div>
<form><p>Your mail</p><input></form><table><tr><td>c1</td><td>c2</td></tr></table></div>
<div class="related-links"><a href=1>Other story with a long long title</a></div><section id="comments"><p>{c}</p></section></div>
<aside>{c}</aside><footer>&copy; 2024</footer></body></html>"""


def test_pages_with_boilerplate(spark):
    talk = "I think that this is a very long comment by a reader. " * 30
    rows = [(n, f"http://h.example/{n}", PAGE.replace("{n}", str(n)).replace("{c}", talk)) for n in range(5)]
    rows += [(10, "http://h.example/x", "<p>no container here</p>"), (11, None, None), (12, "::", ""),
             (13, "http://k.example", "just text & more"), (14, "http://k.example", "<div><p>unclosed <b>bold"),
             (15, "http://k.example/2", "<nav>only</nav>"), (0, "http://h.example/0", rows[0][2])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, salt int")
    got = {}
    for r in html_main.extract_pages(frame).collect():
        got.setdefault(r.page_id, []).append(r.text)
    want = "Head & line\nFirst para graph goes on here.\nSecond <b> one\nitem a\nitem b\nc1 c2"
    assert [got[n] for n in range(1, 5)] == [[want]] * 4 and got[0] == [want, want]
    assert got[10] == ["no container here"] and got[11] == [""] and got[12] == [""]
    assert got[13] == ["just text & more"] and got[14] == ["unclosed bold"] and got[15] == [""]
    assert html_main.extract_pages(frame.limit(0)).count() == 0


def test_host_votes_outvote_a_page(spark):
    """A page whose widest container is not the article follows its host."""
    page = "<body><div class=story><p>{a}</p></div><div class=extra><p>{b}</p></div></body>"
    rows = [(n, "http://v.example/a", page.format(a="story " * 50, b="more " * 5)) for n in range(6)]
    rows.append((9, "http://v.example/b", page.format(a="short story", b="filler " * 40)))
    got = {r.page_id: r.text for r in html_main.extract_pages(spark.createDataFrame(
        rows, "page_id long, url string, html string")).collect()}
    assert got[9] == "short story" and got[0] == ("story " * 50).strip()


def test_every_path_of_a_page_votes(spark):
    """Ten page-specific containers score more than the shared one on each page, which still wins the host."""
    def nest(names, text):
        return "".join(f"<div class={x}>" for x in names) + f"<p>{text}</p>" + "</div>" * len(names)
    pages, talk = [], "some words of a longer block that belongs to this one page only " * 3
    for n, page in enumerate("klmnopqrstuv"):
        own = "".join(nest([page + c + x for x in "xyz"], talk) for c in "abcdefghij")
        pages.append((n, "http://w.example/a", f"<body>{nest(['one', 'two', 'story'], 'story ' * 20)}{own}</body>"))
    got = html_main.extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {("story " * 20).strip()}


def test_text_beside_the_winner_stays(spark):
    """A headline and a lead beside the biggest child, an article in two halves, a title above the article."""
    long = "article text " * 60
    layouts = {
        "a": (f"<article><h1>Head</h1><p>Lead one.</p><div class=entry-content><p>{long}</p></div></article>",
              f"Head\nLead one.\n{long.strip()}"),
        "b": (f"<div class=story><div class=lead><p>{long}</p></div><div class=rest><p>{long[:650]}</p></div></div>",
              f"{long.strip()}\n{long[:650].strip()}"),
        "c": (f"<main><h1>Head</h1><article><div><p>{long}</p></div></article></main><div class=x>Else</div>",
              f"Head\n{long.strip()}"),
        "d": (f"<div class=wrap><div class=list><a href=1>{'other pages ' * 9}</a></div>"
              f"<div class=story><p>{long}</p></div></div>", long.strip())}
    rows = [(f"{k}{n}", f"http://{k}.example/{n}", f"<body>{page}</body>")
            for k, (page, _) in layouts.items() for n in range(3)]
    got = html_main.extract_pages(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: layouts[i[0]][1] for i, _, _ in rows}
    for page, want in layouts.values():
        assert html_main.extract(page, None) == html_main.extract(page, "body>td") == want


def test_wrappers_headers_and_odd_attributes():
    """An article whose wrapper's class holds a boilerplate word; its own header; quotes inside unquoted values."""
    text = "This is the article and it goes on for a while. " * 20
    junk = "A reader says something here that is long enough. " * 200
    for wrap in ('div class="post hentry category-social"', 'div class="post comments-open"', 'div class="story search-engines"',
                 'article class="post promo"', "section id=x1 class='news entry-related'"):
        tag = wrap.split()[0]
        head = "<header><h1>Headline</h1></header>" if tag == "article" else "<h1>Headline</h1>"
        page = (f"<body><div class=nav-menu>Home Shop</div><{wrap}>{head}<p data-x=it's>{text}</p>"
                f"<div class=share>Share this</div><div class='comments'><p>{junk}</p></div></{tag}><footer>Imprint</footer></body>")
        got = html_main.extract(page, None)
        assert got == "Headline\n" + text.strip(), wrap
    side = f"<body><article><p>{text}</p></article><div class='comment-list wide'><p>{junk}</p></div><header><p>Site name</p></header></body>"
    assert html_main.extract(side, None) == text.strip()


def test_bootstrap_against_a_plain_graph(spark):
    rng = random.Random(5)
    slots = []
    for _ in range(900):
        kind = rng.choice([0, 0, 1, -1, -1, -1])
        name = f"{'ab'[kind] if kind >= 0 else 'u'}{rng.randrange(40)}"
        slots.append((kind, name, [f"p{rng.randrange(25) if kind else rng.randrange(8)}" for _ in range(rng.randrange(3))]))
    edges, known = {}, {}
    for kind, name, patterns in slots:
        edges.setdefault(name, set()).update(patterns)
        if kind >= 0:
            known[name] = max(kind, known.get(name, -1))
    want = {}
    while True:
        by = {}
        for name, patterns in edges.items():
            for p in patterns:
                by.setdefault(p, []).append(known.get(name))
        sure = {}
        for p, kinds in by.items():
            share, n, kind = max((kinds.count(k) / len(kinds), kinds.count(k), k) for k in range(4))
            if share >= 0.5 and n >= 3:
                sure[p] = (kind, min(share, 0.999))
        new = {}
        for name, patterns in edges.items():
            if name in known:
                continue
            miss = {}
            for p in patterns & sure.keys():
                kind, c = sure[p]
                miss[kind] = miss.get(kind, 1.0) * (1 - c)
            if miss:
                score, kind = max((1 - v, -k) for k, v in miss.items())
                if score >= 0.75:
                    new[name] = (-kind, score)
        if not new:
            break
        want |= new
        known |= {n: k for n, (k, _) in new.items()}
    df = spark.createDataFrame(slots, "kind int, instance string, patterns array<string>")
    got = {r.instance: (r.kind, r.score) for r in pii.bootstrap(df).collect()}
    assert want and got.keys() == want.keys()
    assert all(got[n][0] == k and abs(got[n][1] - s) < 1e-9 for n, (k, s) in want.items())


def test_third_hop_and_number_runs(spark):
    """Patterns and instances linked over several rounds; an identifier of several tokens."""
    rows, k = [], 0

    def say(text):
        nonlocal k
        rows.append((k, text))
        k += 1
    for i in range(64):
        say(f"please write to user{i}@mail.example now")                          # seeds: "write to _"
    for hop, (n, a, b) in enumerate(((16, "write to", "reach me"), (4, "reach me", "ask for"), (1, "ask for", "find us"))):
        for i in range(n):
            say(f"you {a} token{hop}x{i}99887 first")
            say(f"they {b} token{hop}x{i}99887 then")
    for i in range(16):
        say(f"call me under +49 30 12345{i}7 today")
    for i in range(4):
        say(f"call me under (030) 1234 56{i}8 today")
    got = {r.doc_id: r for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    third = [i for i, t in rows if "token2" in t]
    assert third and all(got[i].n_found == 1 for i in third)
    runs = {i: t for i, t in rows if "(030)" in t}
    for i, t in runs.items():
        s, e = t.index("(030)"), t.index(" today")
        assert got[i].spans == f"phone:{s}:{e}"


def test_private_use_characters_are_no_letters(spark):
    docs = spark.createDataFrame([(i, "palabras de una lengua", "es") for i in range(6)], "doc_id long, text string, lang string")
    models = langid.train(docs)
    assert models.predict(["\ue000\ue001 \uf8ff", "\ue000 lengua"])[0][0] == "und"
    assert models.predict(["\ue000 lengua"])[0][0] == "es"
