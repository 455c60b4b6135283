"""Extraction, decontamination and PPM against plain versions."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from llm.helpers import awkward, docs, vocabulary_texts
from tablestats.llm import decontamination, extraction, ppm

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><article>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/x">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies, many of them, every day</div>
<article><header class="entry-header"><h1>Head  line</h1></header><p>First <b>bold</b> &eacute;&nbsp;para&amp;graph.
more</p><div class="ad">Buy now</div><ul><li>item one<li>item two</ul><p>x<section class="comments"><p>Nice post!</section>
</article><aside>More stories about things</aside><form><p>Enter your mail</form><footer>&copy; 2020 site</footer></body></html>"""


def test_page_of_every_kind():
    weights = extraction.weights_from(extraction.counted([PAGE]))
    assert extraction.extract(PAGE, weights) == "Head line\nFirst bold é para&graph. more\nitem one\nitem two\nx"


def test_page_without_article_element():
    page = ("<body><div id=menu><a>one</a><a>two</a></div><div><p>" + "words " * 30 + "</p><p>end</p></div>"
            "<div class='related'>" + "other " * 50 + "</div>")
    text = extraction.extract(page, {})
    assert text == ("words " * 30).strip() + "\nend"


def test_marks_do_not_drop_the_article_or_its_parts():
    body = "<h2 id='related-work'>Related</h2><section id='search-and-rescue'><p>" + "words " * 30 + "</p></section>"
    body += "<p class='dialog'>he said</p>"
    want = "Related\n" + ("words " * 30).strip() + "\nhe said"
    for page in (f"<div class='layout has-sidebar'><article>{body}</article></div>",
                 f"<div id='page' class='no-comments'><article>{body}</article></div>",
                 f"<article class='post comments-open category-search'>{body}</article>",
                 f"<div class='sidebar'><article>{body}</article></div><div class='related'>{'x ' * 40}</div>",
                 f"<form><nav>a b</nav><article>{body}<div class='sidebar-left ad'>buy</div></article></form>",
                 f"<main>{body}<div id='comments'><article class='comment'>nice</article></div></main>"):
        assert extraction.extract(page, {}) == want, page
    page = "<div class='widget'><p>" + "words " * 30 + "</p><p class='dialog'>he said</p></div><div class='ad'>buy</div>"
    assert extraction.extract(page, {}) == ("words " * 30).strip() + "\nhe said"
    assert extraction.extract("<div>" + "a " * 30 + "</div><div class='cookie-notice'>we use " + "b " * 30 + "</div>",
                              {}) == ("a " * 30).strip()


def test_nested_and_consecutive_articles_and_sibling_sections():
    long = "words " * 30
    text = long.strip()
    for page, want in (
            (f"<nav>n</nav><main><h1>Title</h1><p>Lead</p><article><p>{long}</article></main>", f"Title\nLead\n{text}"),
            (f"<article><h1>T</h1><p>{long}</p><article><p>inner</article><p>end</article>", f"T\n{text}\ninner\nend"),
            (f"<p>x</p><article><p>{long}</article><article><p>{long}</article><p>y", f"{text}\n{text}"),
            (f"<div><article><p>{long}</article><article><p>{long}</article><article>z</article></div>",
             f"{text}\n{text}\nz"),
            (f"<div id=menu>m</div><div><section><p>{long}</section><section><p>{long}</section><section>short</section>"
             "</div><div>away</div>", f"{text}\n{text}\nshort"),
            (f"<section><p>{long}</section><section><p>{long}</p><p>end</section>", f"{text}\n{text}\nend")):
        assert extraction.extract(page, {}) == want, page
    counts = extraction.counted(["<p>out</p><main><article>in one</article><article>in</article></main>"])
    assert (counts["word article", True], counts["word p", False]) == (3, 1)


def test_odd_pages():
    for page in (None, "", "<", "<!-- open", "<p", "<script>x", "&amp", "<p>" * 2000, "</p></div>", "<a b='c"):
        assert isinstance(extraction.extract(page, {}), str)
    assert extraction.extract("a < b &lt; c", {}) == "a < b < c"
    scores = [1.0, -3.0, 2.0, 2.0, -1.0, 0.5]
    assert extraction.best_region(scores) == (2, 4) and extraction.best_region([-1.0]) == (0, 0)


IN_ARTICLE = "<body><article><h1>Title</h1><p>Body words go here.</p><{0}>x y z</{1}><p>End.</p></article></body>"


@pytest.mark.parametrize("tag", ["div class='post-comments'", "div class='reader-comments'", "div class='related-posts'",
                                 "div class='ad-slot'", "div class='share-buttons'", "div class='newsletter-cta'",
                                 "section id='comments'", "aside", "form"])
def test_elements_of_others_inside_an_article_give_no_text(tag):
    page = IN_ARTICLE.format(tag, tag.split()[0])
    assert extraction.extract(page, {}) == "Title\nBody words go here.\nEnd."


@pytest.mark.parametrize("tag", ["h2 id='related-work'", "section id='search-and-rescue'", "p class='dialog'",
                                 "div class='has-sidebar'", "section id='search'", "div class='posts'",
                                 "h2 class='comments'", "div class='entry-header'"])
def test_text_under_like_names_stays(tag):
    page = IN_ARTICLE.format(tag, tag.split()[0])
    assert extraction.extract(page, {}) == "Title\nBody words go here.\nx y z\nEnd."


def test_learned_class_names_cut_elements_out():
    rail = "<div class='right-rail'>most read today</div>"
    labelled = [f"<body><div class='wrap'><article class='wrap'><p>story {i}</p></article></div>{rail}</body>" for i in range(40)]
    weights = extraction.weights_from(extraction.counted(labelled))
    assert [k for k in weights if k.startswith("mark")] == list(extraction._class_names("class='right-rail'"))
    text = "w " * 39 + "w"
    page = f"<body><div class='wrap'><div class='top'><p>{text}</p></div>{rail}<div class='more'><p>{text}</p></div></div></body>"
    assert extraction.extract(page, {}) == f"{text}\nmost read today\n{text}"
    assert extraction.extract(page, weights) == f"{text}\n{text}"
    inside = f"<body><article><p>{text}</p>{rail}<p>{text}</p></article></body>"
    assert extraction.extract(inside, weights) == f"{text}\n{text}"
    # Not where it is most of the page, or holds the article.
    assert extraction.extract(f"<body><div class='right-rail'><p>{text}</p></div><p>a b</p></body>", weights).startswith(text)
    assert extraction.extract(f"<body><div class='right-rail'><article>{text}</article></div></body>", weights) == text


def test_menus_and_footers_count_as_outside():
    counts = extraction.counted(["<body><nav><a>x y</a></nav><article><p>in it</p></article><footer>f</footer></body>"])
    assert counts["word a", False] == 2 and counts["word footer", False] == 1 and counts["word p", True] == 2


def test_extraction_query(spark):
    rows = [(1, "u", PAGE), (2, None, None), (2, "v", ""), (None, "w", "<p>hello")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in extraction.main_text(pages).collect()}
    assert got[2, None] == ("", 0) and got[None, "w"] == ("hello", 5) and len(got) == 4
    assert extraction.main_text(pages.limit(0)).count() == 0


def plain_contamination(texts, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: word.findall((t or "").encode().lower().decode())
    windows = collections.defaultdict(set)
    for item, text in items:
        w = low(text)
        for j in range(len(w) - min(13, len(w)) + 1 if w else 0):
            windows[tuple(w[j:j + 13])].add("" if item is None else str(item))
    out = []
    for doc_id, text in texts:
        w, hit, found = low(text), set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j:j + n]) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[tuple(w[j:j + n])]
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return out


def test_decontamination_matches_plain_search(spark):
    rng = random.Random(2)
    items = [(i, t) for i, t in enumerate(vocabulary_texts(25, 7, words=300, least=1, most=40))]
    items += [(25, items[3][1]), (26, None), (27, "..."), (28, "lone"), (None, "p q r"), (10, "second text of ten")]
    texts = []
    for i in range(80):
        t = vocabulary_texts(1, 100 + i, words=300, most=60)[0].split()
        if i % 2:
            at, piece = rng.randrange(len(t)), rng.choice(items[:26])[1].split()
            cut = rng.randrange(len(piece))
            t[at:at] = (piece if i % 4 == 1 else piece[cut:cut + 13])
        texts.append((i, " ".join(t).upper() if i % 3 else ", ".join(t)))
    texts += awkward() + [(90, "a Lone; word"), (91, "p q r " * 3), (92, texts[1][1]), (92, texts[1][1])]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as row")
    got = decontamination.contamination(docs(spark, texts), bench).drop("row").collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(plain_contamination(texts, items), key=key)
    kept = decontamination.without_contaminated(docs(spark, texts), bench)
    assert kept.count() == sum(not r[-1] for r in plain_contamination(texts, items))
    assert decontamination.contamination(docs(spark, []), bench).count() == 0
    clean = decontamination.contamination(docs(spark, awkward()), bench.limit(0)).collect()
    assert len(clean) == 12 and not any(r.contaminated for r in clean)


def plain_ppm(counts, order, text):
    """Symbol by symbol with explicit exclusion."""
    symbols = [*ppm.normal(text), ppm.END]
    total = 0.0
    for i, s in enumerate(symbols):
        excluded = set()
        for k in range(min(order, i), -1, -1):
            seen = counts.get((k, tuple(symbols[i - k:i])))
            if seen is None:
                continue
            left = {x: n for x, n in seen.items() if x not in excluded}
            den = sum(left.values()) + len(left)
            if s in left:
                total += math.log10(left[s] / den)
                break
            if left:
                total += math.log10(len(left) / den)
            excluded |= set(left)
        else:
            total -= math.log10(max(1, ppm.SYMBOLS - len(excluded)))
    return total


def test_ppm_matches_plain_version():
    texts = vocabulary_texts(30, 3, words=12) + ["abracadabra", "", "ÜbÜ"]
    order = 3
    counts = {}
    for t in texts:
        symbols = [*ppm.normal(t), ppm.END]
        for i, s in enumerate(symbols):
            for k in range(min(order, i) + 1):
                seen = counts.setdefault((k, tuple(symbols[i - k:i])), collections.Counter())
                seen[s] += 1
    model = ppm.Model(ppm.with_shorter(ppm.count_grams(texts, order)))
    tests = ["abba v1 v2", "", None, "zzz~", "v1 v1 v1 V1", "Übermut"]
    np.testing.assert_allclose(model.scores(tests), [plain_ppm(counts, order, t) for t in tests], rtol=1e-4)


def test_ppm_cuts_long_texts_alike(monkeypatch):
    texts = vocabulary_texts(20, 4)
    whole = ppm.Model(ppm.with_shorter(ppm.count_grams(texts)))
    score = whole.scores(texts)
    monkeypatch.setattr(ppm, "_CHUNK", 37)
    cut = ppm.with_shorter(ppm.count_grams(texts))
    assert all((a[0] == b[0]).all() and (a[1] == b[1]).all()
               for a, b in zip(cut.values(), ppm.with_shorter(ppm.count_grams(texts)).values()))
    np.testing.assert_allclose(ppm.Model(cut).scores(texts), score, rtol=1e-6)


def test_ppm_is_a_distribution():
    model = ppm.Model(ppm.with_shorter(ppm.count_grams(vocabulary_texts(40, 5))))
    for before in (b"", b"v1", b"zq v", b"\xff"):
        symbols = [np.array([*before, s], np.uint64) for s in range(ppm.SYMBOLS)]
        known = np.minimum(np.arange(len(before) + 1), ppm.ORDER)
        assert abs(sum(10 ** model.costs(s, known)[-1] for s in symbols) - 1) < 1e-4


def test_scores_of_awkward_table(spark):
    rows = awkward() + [(i, t) for i, t in enumerate(vocabulary_texts(60, 6), 100)]
    got = ppm.score(docs(spark, rows), hot_words=5).collect()
    assert len(got) == len(rows)
    split = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    learnt = collections.Counter()
    ends = 0
    for i, t in rows:
        if not split(i):
            learnt.update((t or "").encode().lower().split())
            ends += 1
    n, v = sum(learnt.values()) + ends, len(learnt) + 1
    want = sorted((i is None, i or 0, len((t or "").split()) + 1, round(sum(
        math.log10((learnt[w] + 1) / (n + v + 1)) for w in (t or "").encode().lower().split())
        + math.log10((ends + 1) / (n + v + 1)), 6)) for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.train_tokens == n and r.held_out == split(r.doc_id) and r.score < 0 for r in got)
    assert ppm.score(docs(spark, [])).count() == 0
    only_held = ppm.score(docs(spark, [(i, "a b") for i in range(60) if split(i)])).first()
    assert only_held.train_tokens == 0 and only_held.n_known == 0


def test_scores_do_not_depend_on_the_broadcast_bound(spark):
    rows = awkward() + [(i, t) for i, t in enumerate(vocabulary_texts(60, 8), 100)]
    rows += [(i, f"ünseen {i}{chr(97 + i % 26)} ~~~") for i in range(200, 240)]
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens)
    whole = sorted(ppm.score(docs(spark, rows)).collect(), key=key)
    for bound in (3, 400):
        part = sorted(ppm.score(docs(spark, rows), max_nodes=bound).collect(), key=key)
        assert [key(r) for r in part] == [key(r) for r in whole]
        np.testing.assert_allclose([r.score for r in part], [r.score for r in whole], rtol=1e-5)


def test_grams_are_counted_and_looked_up_by_shards(spark, monkeypatch):
    rows = awkward() + [(i, t) for i, t in enumerate(vocabulary_texts(60, 9), 100)] + [(300, "zq"), (301, "Ω v1")]
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens)
    whole = sorted(ppm.score(docs(spark, rows)).collect(), key=key)
    monkeypatch.setattr(ppm, "SHARD_BYTES", 300)
    tables, first = [], ppm.written
    monkeypatch.setattr(ppm, "written", lambda df, name: tables.append((name, first(df, name))) or tables[-1][1])
    monkeypatch.setattr(ppm, "dropped", lambda table: None)
    part = sorted(ppm.score(docs(spark, rows), max_nodes=50).collect(), key=key)
    np.testing.assert_allclose([r.score for r in part], [r.score for r in whole], rtol=1e-5)
    assert {name for name, _ in tables} == {"grams", "words", "scored", "more"}
    grams, asked = (dict(tables)[name] for name in ("grams", "scored"))
    assert grams.where("shard >= 0").select("shard").distinct().count() > 5
    # One row for a shard and order, and no gram of a text that stands in a row of its own.
    assert grams.where("shard >= 0").groupBy("shard", "level").count().where("count > 1").count() == 0
    assert asked.where("shard >= 0").count() < asked.where("shard >= 0").selectExpr("sum(size(codes))").first()[0] / 5


def test_least_count_keeps_within_the_bound():
    assert ppm.least_count([(1, 100), (2, 50), (3, 10)], 200) == 1
    assert ppm.least_count([(1, 100), (2, 50), (3, 10)], 60) == 2
    assert ppm.least_count([(1, 100), (2, 50), (3, 10)], 5) == 4
