"""Ranked search: sorted reads against scores of all documents."""

import math
import random
import re
from collections import Counter

import pytest

from conftest import SF001
from llm.helpers import awkward, docs, vocabulary_texts
from tablestats.llm import queries, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWERED))


def plain_search(rows, items, top=10):
    known = [(i, Counter(t), len(t)) for i, x in rows if (t := plain_terms(x))]
    n_docs, n_terms, df = len(known), sum(n for _, _, n in known), Counter()
    for _, c, _ in known:
        df.update(c.keys())
    out = []
    for item_id, text in sorted(set(items), key=str):
        scored = []
        for i, c, n in known:
            m, score = 100 - 75 + (75 * n * n_docs) // n_terms, 0
            for t, times in Counter(plain_terms(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is not None, i or 0, i))
        out += [(item_id, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 0) for r in rows], "item_id long, text string, c string, t int")


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_registered_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    df = queries.QUERIES["op12_ranked_search"](spark, SF001)
    assert df.columns[:4] == ["item_id", "rank", "doc_id", "score"]
    assert found(df) == plain_search(rows, items)


@pytest.fixture
def hard():
    rng = random.Random(3)
    texts = vocabulary_texts(250, 11) + ["v1 v2 v3 v3"] * 60 + ["v1 V2 v3 v4"] * 30
    rows = list(enumerate(texts)) + [(i, t) for i, t in awkward()] + [(500 - i, "v1 v2 v3 v3") for i in range(20)]
    rng.shuffle(rows)
    items = [(i, t) for i, t in enumerate(vocabulary_texts(12, 5, most=15))]
    items += [(50, "v1 V2 v3 v3"), (51, None), (52, " ; "), (53, "unknown words"), (50, "v1 V2 v3 v3"), (50, "v4"), (None, "v5 v5 the"),
              (54, " ".join(f"v{i % 60} w{i % 40}" for i in range(300)))]
    return rows, items


def test_ties_copies_and_hard_rows_at_every_block_size(spark, hard):
    rows, items = hard
    want = plain_search(rows, items)
    for first in (1, ranked_search.FIRST_PAIRS):
        assert found(ranked_search.search(docs(spark, rows), items_of(spark, items), first_pairs=first)) == want
    assert found(ranked_search.search(docs(spark, rows), items_of(spark, items), top=3)) == plain_search(rows, items, 3)


def test_without_shared_vocabulary_and_broadcasts(spark, hard, monkeypatch):
    rows, items = hard
    monkeypatch.setattr(ranked_search, "VOCABULARY", 0)
    monkeypatch.setattr("tablestats.llm.common.BROADCAST_ROWS", 0)
    assert found(ranked_search.search(docs(spark, rows), items_of(spark, items))) == plain_search(rows, items)


def test_fewer_documents_than_places_and_empty_tables(spark):
    few = [(1, "a b"), (2, "b c"), (3, None)]
    assert found(ranked_search.search(docs(spark, few), items_of(spark, [(1, "b"), (2, "z")]))) == plain_search(few, [(1, "b"), (2, "z")])
    assert ranked_search.search(docs(spark, []), items_of(spark, [(1, "b")])).count() == 0
    assert ranked_search.search(docs(spark, few), items_of(spark, [])).count() == 0
    assert ranked_search.search(docs(spark, [(1, None), (2, " ")]), items_of(spark, [(1, "b")])).count() == 0
