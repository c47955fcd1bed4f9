"""Main text of web pages by consensus host paths.

Pass 1 parses each page, scores its containers by the text that hangs under them (link text counts
against, a parent gets half) and emits all its generalised tag-class paths with their scores. Spark adds
up the votes per (host, path), one partial aggregate, and picks each host's winner, which is then widened:
to its outermost ``article``, and upward (to ``main``, or without either to any container below ``body``) to
the path with the most text under it, link text counting against, so that headlines and further parts beside
the winner stay. Pass 2 re-extracts every page along its host's widened path; a page without it, or with no
text under it, uses its own best path, widened alike.
For the second join a host's winner is replicated ``salts`` times and its pages spread over the
replicas, so a host with a third of all pages does not meet in one task.

Left out everywhere: menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments,
known by tag or by a word of their class, id or role. A word inside a longer class name does not condemn an element that
wraps the article (``class="post comments-open"``): if another class does not say so, and the element holds most of
the page's unlinked text while little, and no ``article`` or ``main``, stands outside all elements marked like it, it
counts as unmarked. A ``header`` inside ``article`` or ``main`` is the article's own. Character references are decoded, white space
inside a block becomes one space, blocks are joined by line feeds in page order; ``br`` is white space.

Rules: null html is an empty page with empty text; pages with null or odd URLs vote under their own host
name ''; equal votes go to the longer path, then by name; text outside any element belongs to ``body``.
Extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.session import stage

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|select|svg|iframe|object|math|title)(?![\w-])[^>]*>"
    r".*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:[^>=]++|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)>",
    re.S | re.I)
_ATTR = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

#: Tags that start and end a block of text.
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre
section summary table tbody tfoot thead tr ul""".split())
#: Blocks whose path text may be voted for.
CONTAINERS = frozenset("article body center div main section td".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open paragraph or heading ends where one of the blocks begins; items end at the next item.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("article aside body details dialog div dl footer form header html li main nav ol section "
                   "table tbody td th tr ul".split())
BOILER_TAGS = frozenset("aside button dialog footer form header input label menu nav".split())
BOILER_WORDS = frozenset("""ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments
consent cookie cookies disqus footer form gdpr header masthead menu modal nav navbar navigation newsletter
notice notification pagination popup promo promoted related replies search share sharing sidebar signup social
sponsor sponsored subscribe toolbar widget""".split())
BOILER_ROLES = frozenset("banner complementary contentinfo dialog form navigation search".split())
_WORDS = re.compile(r"[a-z]+")


class Block(NamedTuple):
    text: str
    links: int                 # code points inside links
    path: tuple[str, ...]      # generalised containers from body down


def _names(tag: str, attrs: str) -> tuple[str, int]:
    """Generalised classes of a tag and whether its attributes mark boilerplate: 0 no, 1 perhaps, 2 yes.

    Perhaps: only a word inside a longer class name does, or the tag is the article's, and another class does not.
    """
    label, mark = "", 0
    if "=" in attrs:
        for m in _ATTR.finditer(attrs):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name == "role":
                mark = max(mark, 2 * (value in BOILER_ROLES))
                continue
            own = [c for c in value.split() if not c.startswith(("no-", "has-", "with-"))]
            bad = [c for c in own if not BOILER_WORDS.isdisjoint(_WORDS.findall(c))]
            if bad:
                part = tag in ("article", "main") or not any(c in BOILER_WORDS for c in bad)
                mark = max(mark, 1 if part and len(bad) < len(own) else 2)
            if name == "class":
                label = "".join("." + re.sub(r"[0-9]+", "#", c) for c in sorted(value.split()))
    return label, mark


def _unmarked(out: list[tuple[Block, tuple[int, ...]]]) -> list[Block]:
    """Blocks outside marked elements, where an element that wraps the article does not count as marked."""
    free: set[int] = set()
    while True:
        held: dict[int, int] = defaultdict(int)
        outside = total = 0
        article = False
        for b, marks in out:
            worth = max(len(b.text) - b.links, 0)
            total += worth
            first = next((m for m in marks if m not in free), None)
            if first is None:
                outside += worth
                article |= any(x.startswith(("article", "main")) for x in b.path)
            else:
                held[first] += worth
        big = max(held, key=lambda m: (held[m], -m), default=None)
        if big is None or article or 2 * held[big] <= total or 4 * outside >= held[big]:
            return [b for b, marks in out if free.issuperset(marks)]
        free.add(big)


def blocks_of(page: str) -> list[Block]:
    """Text blocks of a page outside boilerplate, with their container paths."""
    out: list[tuple[Block, tuple[int, ...]]] = []
    # Open elements: tag, path label (containers only), whether the tag is boilerplate, its mark (0: none).
    stack: list[tuple[str, str, bool, int]] = []
    path: tuple[str, ...] = ("body",)
    marks: tuple[int, ...] = ()
    marked = 0
    boiler = links = 0
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            if text := " ".join(html.unescape("".join(parts)).split()):
                out.append((Block(text, min(linked, len(text)), path), marks))
            parts.clear()
        linked = 0

    def pop() -> None:
        nonlocal boiler, links, path, marks
        if stack[-1][3]:
            flush()
        tag, label, bad, mark = stack.pop()
        boiler -= bad
        if mark:
            marks = marks[:-1]
        links -= tag == "a"
        if label:
            path = path[:-1]

    def say(text: str) -> None:
        nonlocal linked
        if text and not boiler:
            parts.append(text)
            if links:
                linked += len(text)

    at = 0
    for m in _TOKEN.finditer(page):
        say(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"]:
            if tag == "p" and not any(x[0] == "p" for x in stack):
                flush()
                continue
            if tag in BLOCKS or tag in ("td", "th"):
                flush() if tag in BLOCKS else say(" ")
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    while len(stack) > k:
                        pop()
                    break
                if stack[k][0] in SCOPES and tag not in SCOPES:
                    break
            continue
        if tag in BLOCKS:
            flush()
            for k in range(len(stack) - 1, -1, -1):          # an open paragraph or heading ends here
                if stack[k][0] in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
                    while len(stack) > k:
                        pop()
                    break
                if stack[k][0] in SCOPES:
                    break
        if tag in CLOSES:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in CLOSES[tag]:
                    while len(stack) > k:
                        pop()
                    break
                if stack[k][0] in ("ul", "ol", "dl", "table", "div", "article", "section", "body"):
                    break
        if tag in ("td", "th", "br", "img"):
            say(" ")
        if tag in VOID or tag in ("body", "html"):
            continue
        label, named = _names(tag, m["attrs"])
        bad = named == 2 or (tag in BOILER_TAGS and not (
            tag == "header" and any(x[0] in ("article", "main") for x in stack)))
        mark = 0
        if named and not bad:
            flush()
            marked += 1
            mark = marked
            marks = (*marks, mark)
        boiler += bad
        links += tag == "a"
        own = tag + label if tag in CONTAINERS else ""
        if own:
            path = (*path, own)
        stack.append((tag, own, bad, mark))
    say(page[at:])
    flush()
    return _unmarked(out)


def scores(blocks: list[Block]) -> dict[str, float]:
    """Score of each generalised path of one page."""
    total: dict[str, float] = defaultdict(float)
    for b in blocks:
        worth = len(b.text) - 1.5 * b.links
        steps = b.path
        for up in range(min(3, len(steps))):
            total[">".join(steps[:len(steps) - up])] += worth * 0.5 ** up
    for path in total:
        last = path.rsplit(">", 1)[-1]
        if re.match(r"(article|main)\b", last):
            total[path] *= 1.5
    return {p: s for p, s in total.items() if s > 0}


def worths(blocks: list[Block]) -> dict[str, float]:
    """Text under each generalised path of one page, at any depth, link text counting against."""
    total: dict[str, float] = defaultdict(float)
    for b in blocks:
        for n in range(1, len(b.path) + 1):
            total[">".join(b.path[:n])] += len(b.text) - 1.5 * b.links
    return total


def ladder(path: str) -> list[str]:
    """Paths a winner may be widened to, deepest first."""
    steps = path.split(">")
    tags = [x.split(".", 1)[0] for x in steps]
    low = tags.index("article") + 1 if "article" in tags else len(steps)
    high = tags.index("main") + 1 if "main" in tags else low if "article" in tags else 2
    return [">".join(steps[:n]) for n in range(low, min(low, high) - 1, -1)]


def best_path(votes: dict[str, float]) -> str:
    return max(votes, key=lambda p: (round(votes[p], 3), p.count(">"), p), default="body")


def under(blocks: list[Block], path: str) -> str:
    """Text of the blocks at or below a path."""
    steps = tuple(path.split(">"))
    return "\n".join(b.text for b in blocks if b.path[:len(steps)] == steps)


def extract(page: str | None, winner: str | None) -> str:
    blocks = blocks_of(page or "")
    if winner and (text := under(blocks, winner)):
        return text
    worth = worths(blocks)
    return under(blocks, max(ladder(best_path(scores(blocks))), key=lambda p: worth.get(p, 0.0)))


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1),
                              F.lit("")))


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("path", T.StringType()),
                                       T.StructField("score", T.DoubleType()),
                                       T.StructField("worth", T.DoubleType())])))
def page_votes(pages: pa.Array) -> pa.Array:
    out = []
    for p in pages:
        blocks = blocks_of(p.as_py() or "")
        own = scores(blocks)
        out.append([{"path": x, "score": own.get(x, 0.0), "worth": w} for x, w in worths(blocks).items()])
    return pa.array(out, pa.list_(pa.struct([("path", pa.string()), ("score", pa.float64()),
                                             ("worth", pa.float64())])))


@F.arrow_udf(T.ArrayType(T.StringType()))
def wider_paths(paths: pa.Array) -> pa.Array:
    return pa.array([ladder(p.as_py()) for p in paths], pa.list_(pa.string()))


@F.arrow_udf(T.StringType())
def page_text(pages: pa.Array, winners: pa.Array) -> pa.Array:
    return pa.array([extract(p.as_py(), w.as_py()) for p, w in zip(pages, winners, strict=True)], pa.string())


def host_paths(pages: DataFrame) -> DataFrame:
    """Winning path of every host, widened (host, path)."""
    votes = stage(
        pages.select(host_of(F.col("url")).alias("host"), F.explode(page_votes(F.col("html"))).alias("v"))
        .groupBy("host", "v.path").agg(F.sum(F.round("v.score", 3)).alias("score"), F.sum("v.worth").alias("worth")),
        "host-votes")
    depth = F.length(F.translate("path", "abcdefghijklmnopqrstuvwxyz", ""))
    best = (votes.filter("score > 0").groupBy("host")
            .agg(F.max_by("path", F.struct(F.round("score", 1), depth, F.col("path"))).alias("best")))
    wider = best.select("host", F.explode(wider_paths("best")).alias("path"))
    return (wider.join(votes, ["host", "path"]).groupBy("host")
            .agg(F.max_by("path", F.struct("worth", F.length("path"))).alias("path")))


def extract_pages(pages: DataFrame, salts: int = 32) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    pages = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    # Written once: its measured size decides whether the pages need to move at all.
    winners = stage(host_paths(pages), "host-paths").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = F.pmod(F.xxhash64("page_id", F.length("html")), F.lit(salts)).cast("int")
    out = (pages.withColumn("host", host_of(F.col("url"))).withColumn("salt", spread)
           .join(winners, ["host", "salt"], "left")
           .select("page_id", "url", page_text("html", "path").alias("text")))
    return out.withColumn("n_chars", F.length("text").cast("long"))
