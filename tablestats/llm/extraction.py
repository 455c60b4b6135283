"""Main text of web pages: maximum-scoring subsequence of words and tags.

A page is a sequence of tags and words.  Words score above 0 and tags below,
and one linear scan finds the contiguous region with the highest sum.  The
weights come from labelled pages: a page with ``article`` (or ``main``)
elements labels all its words, tags and class names as inside or outside, menus and
footers included, and a kind seen more often outside scores lower.  A class name that
is seen outside twenty times as often as in or around articles takes its
elements out of the text (not those that hold an article or over a third of the
page's words), inside an article as well.  Elements that are never article
text (menus, page headers and footers, sidebars, notices, adverts, forms,
scripts, comments of readers; by element, or by role, class or id whose every
word says so) score nothing and give no text, unless they hold the article or
nearly all words of the page.  Marks of headings, paragraphs and other elements
of text are read for adverts only, and ids only where containers bear them.
A region in an article element stands for the whole outermost one, a region over
several for the nearest container around them (else for each of them), and one
outside of any for the nearest container around it, so that short paragraphs and
sections at its ends are not lost.

Scale: one pass counts the kinds of all labelled pages (a small table: tag
names are a fixed set, class names fall into ``MARKS`` buckets), one pass extracts;
no page is shuffled.

Defined cases: a null or empty page gives an empty text; a page without words
too; very long pages are read whole, in time linear in their length; of regions with one
score the first counts; unclosed elements end with their parents; unknown tags count as one kind;
repeated pages are extracted each; further columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tablestats.llm.common import small_batches

#: HTML's element names by what they mean here.
NEVER = frozenset("head script style noscript template iframe svg canvas object nav footer aside form button select "
                  "textarea menu dialog audio video datalist".split())
RAW = frozenset("script style textarea title noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section "
                  "summary table tbody td tfoot th thead title tr ul".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
HOME = frozenset(("article", "main"))
HOLDERS = frozenset(("article", "main", "section", "div", "td"))
#: Words of class, id and role that mark an element as no article text.
BOILER = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie "
                   "cookies consent gdpr notice notices sidebar nav navbar navigation menu breadcrumb breadcrumbs "
                   "masthead footer comment comments reply replies respond disqus form newsletter subscribe signup "
                   "login share sharing social related recommended popup modal overlay widget pagination pager "
                   "toolbar topbar contentinfo complementary search dialog alert".split())
#: Those that don't count inside an article, where a heading may bear them.
OUTSIDE_ONLY = frozenset(("header",))
#: The only ones that count for elements of text (paragraphs, headings, items, inline elements).
ADVERTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo".split())
TEXT = INLINE | frozenset("blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 legend li p pre summary td th".split())
#: Words that a mark may have besides: any other word ("has-sidebar", "related-work") makes it none.
PLACES = frozenset("area article articles bar block bottom box button buttons col column container content count cta entry "
                   "feed footer form global icons inner item items left link links list main menu outer page panel post "
                   "posts primary reader readers right row secondary section site slot slots stories story thread "
                   "top unit units user users visitor visitors wrap wrapper zone".split())
#: With one of these a header is the article's own.
OWN = frozenset("article entry post story".split())
#: Ids of sections are made from headings as a rule; these name the comments of readers.
COMMENTS = frozenset("comment comments reply replies respond disqus".split())
#: Elements that NEVER lists but that may stand around a whole page.
AROUND = frozenset("nav footer aside form menu dialog".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?>[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
_MARKS = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
#: Buckets of class names; the log odds that take an element out.
MARKS = 1 << 16
OUTSIDE_ODDS = -3.0


def _kind(name: str) -> str:
    return name if name in BLOCK or name in INLINE or name in NEVER or name in VOID else "other"


def _marked(name: str, attrs: str, home: bool) -> bool:
    """Whether the element says of itself that it is no article text."""
    if name in AROUND or (name == "header" and not home):
        return True
    if not attrs or name in ("html", "body", "main"):
        return False
    if _HIDDEN.search(attrs):
        return True
    boiler = ADVERTS if name in TEXT else BOILER if home else BOILER | OUTSIDE_ONLY
    for kind, value in _MARKS.findall(attrs):
        named = boiler
        if kind.lower() == "id" and (name in TEXT or name == "section"):
            if name != "section":
                continue  # a place to link to, made from the heading's words
            named = COMMENTS
        for token in _html.unescape(value.strip("\"'")).split():
            words = {w for w in _SPLIT.split(_CAMEL.sub("-", token).lower()) if w}
            if words & named and words <= named | PLACES and not (words & named <= OUTSIDE_ONLY and words & OWN):
                return True
    return False


def _class_names(attrs: str) -> tuple[str, ...]:
    """The kinds ``mark N`` of an element's class names."""
    names = {token.lower() for kind, value in _MARKS.findall(attrs) if kind.lower() == "class"
             for token in _html.unescape(value.strip("\"'")).split()}
    return tuple(f"mark {zlib.crc32(n.encode('utf-8', 'surrogatepass')) % MARKS}" for n in sorted(names))


@dataclass
class Tree:
    """Marked elements, articles and containers of a page; 0 stands for the page."""
    parent: list[int] = field(default_factory=lambda: [0])
    words: list[int] = field(default_factory=lambda: [0])
    marked: list[bool] = field(default_factory=lambda: [False])
    home: list[bool] = field(default_factory=lambda: [False])
    holder: list[bool] = field(default_factory=lambda: [False])
    marks: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    learned: list[bool] = field(default_factory=lambda: [False])

    def around_homes(self) -> list[bool]:
        """Article elements and all that hold one."""
        out = list(self.home)
        for i in range(len(out) - 1, 0, -1):
            out[self.parent[i]] |= out[i]
        return out

    def dropped(self) -> list[bool]:
        """Marked elements and all in them, but for those that hold the article (an article
        element with most of the page's words, or the largest if all are marked and it has a
        quarter) or at least four of five words; and elements with learned marks, see above."""
        words, inside, n = list(self.words), list(self.marked), len(self.parent)
        for i in range(n - 1, 0, -1):
            words[self.parent[i]] += words[i]
        for i in range(1, n):
            inside[i] |= inside[self.parent[i]]
        homes = [i for i in range(1, n) if self.home[i]]
        safe = [5 * w >= 4 * words[0] for w in words]
        for i in homes:
            safe[i] |= 2 * words[i] > words[0]
        if homes and all(inside[i] for i in homes):
            most = max(homes, key=lambda i: (words[i], -i))
            safe[most] |= 4 * words[most] >= words[0]
        for i in range(n - 1, 0, -1):
            safe[self.parent[i]] |= safe[i]
        out, holds = [False] * n, self.around_homes()
        for i in range(1, n):
            learned = self.learned[i] and not holds[i] and 3 * words[i] <= words[0]
            out[i] = out[self.parent[i]] or (self.marked[i] and not safe[i]) or learned
        return out


@dataclass
class Page:
    """``kinds[i]``, ``sizes[i]`` and place in ``tree`` of each scored event; blocks of text."""
    tree: Tree = field(default_factory=Tree)
    kinds: list[str] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    nodes: list[int] = field(default_factory=list)
    blocks: list[tuple[int, int, str]] = field(default_factory=list)  # first event, place, text
    homes: int = 0

    def outermost(self, kind: list[bool]) -> list[int]:
        """For each place of the tree the outermost one around it that ``kind`` marks, 0: none."""
        out = [0] * len(kind)
        for i in range(1, len(kind)):
            out[i] = out[self.tree.parent[i]] or (i if kind[i] else 0)
        return out


def parse(source: str | None, weights: dict[str, float] | None = None, *, whole: bool = False) -> Page:
    """Events and blocks of a page; ``whole`` keeps those of elements that give no text."""
    weights = weights or {}
    page, source = Page(), source or ""
    tree = page.tree
    stack: list[tuple[str, bool, int, bool]] = []  # name, never text, place and article around
    skip, node, home, parts, raw_blocks = 0, 0, False, [], []

    def event(kind: str, size: int) -> None:
        page.kinds.append(kind)
        page.sizes.append(size)
        page.nodes.append(node)

    def flush() -> None:
        nonlocal parts
        if parts:
            raw_blocks.append(parts)
            parts = []

    def text(raw: str) -> None:
        if skip or not raw:
            return
        raw = _html.unescape(raw) if "&" in raw else raw
        n = len(raw.split())
        parts.append((len(page.kinds) if n else -1, node, raw))
        if n:
            event("word " + _kind(stack[-1][0] if stack else "other"), n)
            tree.words[node] += n

    at, end = 0, len(source)
    while at < end:
        m = _TOKEN.search(source, at)
        if m is None:
            text(source[at:])
            break
        text(source[at:m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name in BLOCK:
            flush()
        if not skip:
            event("tag " + _kind(name), 1)
        if m["end"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    flush() if any(x[0] in BLOCK for x in stack[i:]) else None
                    skip -= sum(x[1] for x in stack[i:])
                    node, home = stack[i][2:]
                    del stack[i:]
                    break
        elif name not in VOID and not m["attrs"].endswith("/"):
            out = name in NEVER and name not in AROUND
            stack.append((name, out, node, home))
            skip += out
            marked = not skip and _marked(name, m["attrs"], home)
            if marked or (name in HOLDERS and not skip):
                marks = _class_names(m["attrs"]) if m["attrs"] and name not in HOME else ()
                learned = any(weights.get(k, 0.0) <= OUTSIDE_ODDS for k in marks)
                for column, value in ((tree.parent, node), (tree.words, 0), (tree.marked, marked),
                                      (tree.home, name in HOME), (tree.holder, name in HOLDERS),
                                      (tree.marks, marks), (tree.learned, learned)):
                    column.append(value)
                node = len(tree.parent) - 1
                home = home or name in HOME
            if name in RAW:
                close = re.compile(rf"</{name}\b[^>]*>", re.I).search(source, at)
                if name == "title":
                    skip, _ = skip + 1, text(source[at:close.start()] if close else source[at:])
                    skip -= 1
                at = close.end() if close else end
                skip -= out
                stack.pop()
    flush()
    return _without_dropped(page, raw_blocks, [False] * len(tree.parent) if whole else tree.dropped())


def _without_dropped(page: Page, raw_blocks: list[list[tuple[int, int, str]]], gone: list[bool]) -> Page:
    keep = [i for i, node in enumerate(page.nodes) if not gone[node]]
    place = {i: j for j, i in enumerate(keep)}
    for name in ("kinds", "sizes", "nodes"):
        column = getattr(page, name)
        setattr(page, name, [column[i] for i in keep])
    for parts in raw_blocks:
        parts = [x for x in parts if not gone[x[1]]]
        first = next(((place[i], node) for i, node, _ in parts if i >= 0), None)
        if first:
            page.blocks.append((*first, " ".join("".join(raw for _, _, raw in parts).split())))
    page.homes = len({h for i, h in enumerate(page.outermost(page.tree.home)) if h and not gone[i]})
    return page


def best_region(scores) -> tuple[int, int]:
    """First and one past the last event of the highest sum (empty if none is above 0)."""
    best, total, start, region = 0.0, 0.0, 0, (0, 0)
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, region = total, (start, i + 1)
    return region


def counted(pages: Iterator[str | None]) -> dict[tuple[str, bool], int]:
    """How often each kind lies inside and outside of the article of labelled pages."""
    out: Counter = Counter()
    for source in pages:
        page = parse(source, whole=True)
        if page.homes:
            home, holds = page.outermost(page.tree.home), page.tree.around_homes()
            for kind, size, node in zip(page.kinds, page.sizes, page.nodes, strict=True):
                out[kind, home[node] > 0] += size
            for node, marks in enumerate(page.tree.marks):
                for mark in marks:
                    out[mark, home[node] > 0 or holds[node]] += 1
    return out


def weights_from(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log odds of inside against outside, held above 0 for words and below for tags.

    Class names count where they take elements out."""
    inside = {k: n for (k, home), n in counts.items() if home}
    outside = {k: n for (k, home), n in counts.items() if not home}
    out = {}
    for k in inside.keys() | outside.keys():
        odds = float(np.log((inside.get(k, 0) + 1) / (outside.get(k, 0) + 1)))
        if k.startswith("mark"):
            if odds <= OUTSIDE_ODDS:
                out[k] = odds
            continue
        out[k] = min(max(odds, 0.1), 3.0) if k.startswith("word") else min(max(odds, -6.0), -0.05)
    return out


def extract(source: str | None, weights: dict[str, float]) -> str:
    page = parse(source, weights)
    scores = [n * weights.get(k, 1.0 if k.startswith("word") else -1.0)
              for k, n in zip(page.kinds, page.sizes, strict=True)]
    a, b = best_region(scores)
    tree = page.tree
    home, top = page.outermost(tree.home), page.outermost(tree.holder)
    inside = {page.nodes[i] for i in range(a, b) if page.kinds[i].startswith("word")}
    if not inside:
        return ""
    homes = {home[node] for node in inside} - {0}
    shared = homes or inside
    under = [int(i in shared) for i in range(len(tree.parent))]
    for i in range(len(under) - 1, 0, -1):
        under[tree.parent[i]] += under[i]
    container = max((i for i, n in enumerate(under) if n == len(shared) and tree.holder[i]), default=0)
    # Where only the page is around all of it: each article, or each container right below the page.
    chosen = {container} if container else homes or {top[node] for node in inside} - {0}
    covered = [False] * len(under)
    for i in range(1, len(under)):
        covered[i] = i in chosen or covered[tree.parent[i]]
    return "\n".join(t for i, node, t in page.blocks if covered[node] or (a <= i < b and not homes))


def learn(pages: DataFrame) -> dict[str, float]:
    """Weights from all pages that label themselves; few counts (``MARKS`` and some) reach the driver."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            total.update(counted(batch["html"]))
        yield pd.DataFrame([(k, home, n) for (k, home), n in total.items()], columns=["kind", "inside", "n"])

    rows = (pages.select("html").mapInPandas(count, "kind string, inside boolean, n long")
            .groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect())
    return weights_from({(r["kind"], r["inside"]): r["n"] for r in rows})


def main_text(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``page_id, url, text, n_chars``."""
    small_batches(pages.sparkSession)
    weights = learn(pages) if weights is None else weights

    @F.pandas_udf(StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([extract(x, weights) for x in batch], dtype=object)

    return (pages.select("page_id", "url", run("html").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
