"""Classifiers: held-out accuracy, identity swaps, edge tables."""

import zlib

import numpy as np
import pytest

from conftest import SF01
from llm.helpers import awkward, docs
from tablestats.llm import labelled, quality, toxicity
from tablestats.llm.common import table

SF1 = "/root/testdata/sf0.1"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").selectExpr("*", "'x' as text")


@pytest.mark.parametrize("part,column,least", [(toxicity, "toxic", 0.9), (quality, "quality", 0.95)])
def test_held_out_accuracy(spark, part, column, least):
    found = part.classify(table(spark, SF01, "documents"), table(spark, SF01, "labels"))
    rows = found.join(table(spark, SF01, "labels"), "doc_id").where("held_out").collect()
    assert len(rows) > 40
    assert np.mean([r["predicted"] == r[column] for r in rows]) >= least
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("part", [toxicity, quality])
def test_awkward_and_empty_tables(spark, part):
    rows = awkward()
    some = labels(spark, [(1, 1, 0), (4, 0, 1), (4, 0, 0), (7, 0, 1), (8, 1, None), (None, 0, 1), (99, 1, 1), (5, None, 0)])
    got = part.classify(docs(spark, rows), some).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert part.classify(docs(spark, rows), some.limit(0)).count() == len(rows)
    assert part.classify(docs(spark, []), some).count() == 0


def test_sample_has_one_row_per_id_and_text(spark, monkeypatch):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % quality.MODULUS != quality.HELD_OUT]
    rows = [(i, f"text number {i} " * (i + 1)) for i in ids] + [(ids[0], "hot copy")] * 300
    rows += [(ids[1], f"another text {k}") for k in range(40)]
    some = labels(spark, [(i, i % 2, i % 2) for i in ids])
    seen = []
    monkeypatch.setattr(quality, "grow", lambda x, y, **how: seen.append(len(y)) or 0.5)
    quality.train(docs(spark, rows), some)
    assert seen == [len(ids) + 1 + labelled.TEXTS_PER_ID - 1]


def test_swapping_keeps_identity_words_out_of_the_score():
    rng = np.random.default_rng(0)
    swap = toxicity.swaps()
    y, x, pairs = [], [], []
    for i in range(600):
        toxic = i % 2
        found = {f"w{k}" for k in rng.integers(0, 200, 12)}
        if toxic and rng.random() < 0.8:
            found.add("vile")
        if rng.random() < (0.7 if toxic else 0.1):  # the sample names one group mostly in toxic texts
            found.add("muslims")
        swapped = toxicity.swapped(found, swap)
        y.append(toxic)
        x.append(toxicity.features(found))
        if swapped is not None:
            pairs.append((x[-1], toxicity.features(swapped)))
    plain = toxicity.fit(np.array(y, float), x, pairs, counterfactual=0.0)
    fair = toxicity.fit(np.array(y, float), x, pairs, counterfactual=50.0)
    neutral = "muslims met for tea"
    with_group = [toxicity.Scorer(m).margin(neutral) - toxicity.Scorer(m).margin("met for tea") for m in (plain, fair)]
    assert with_group[0] > 0.5 and abs(with_group[1]) < 0.3 * with_group[0]
    assert toxicity.Scorer(fair).margin("a vile text") > toxicity.Scorer(fair).margin(neutral)


def test_pairs_change_one_sentence_each():
    swap = toxicity.swaps()
    assert toxicity.sentence_pairs("Nothing here. Or there.", swap) == [] == toxicity.sentence_pairs(None, swap)
    text = "The women left! Les juifs et les vieux. Nothing.\nThe women left. " + "The women came. " * 5_000
    found = toxicity.sentence_pairs(text, swap)
    for old, new in ((["women"], ["men"]), (["juifs", "vieux"], ["hindous", "jeunes"])):
        a, b = toxicity.features(set(old)), toxicity.features(set(new))
        assert any(np.array_equal(g, np.setdiff1d(a, b)) and np.array_equal(n, np.setdiff1d(b, a)) for g, n in found)
    assert len(found) == 2
    pair = np.array([i for i, (a, b) in enumerate(found) for _ in (*a, *b)])
    change = np.array([v for a, b in found for v in (*a, *~b)])
    again = list(toxicity._pairs_of(pair, change))
    assert all(np.array_equal(p, q) for f, g in zip(found, again, strict=True) for p, q in zip(f, g, strict=True))


@pytest.mark.parametrize("lang,group,others", [("en", "muslims", "christians"), ("fr", "juifs", "chrétiens")])
def test_swaps_lower_false_positives_on_held_out_mentions(spark, lang, group, others):
    rng = np.random.default_rng(5)
    rows, marks = [], []
    for i in range(900):
        toxic = i % 2
        said = " ".join(f"w{k}" for k in rng.integers(0, 300, 15))
        held = zlib.crc32(str(i).encode()) % toxicity.MODULUS == toxicity.HELD_OUT
        # No other word tells who is named: labelled texts name one group mostly in toxic ones; held-out clean texts name it too
        named = rng.random() < ((0.0 if toxic else 0.9) if held else (0.9 if toxic else 0.05))
        rows.append((i, f"{said}. {'vile' if toxic and rng.random() < 0.7 else 'so'} {group if named else others if rng.random() < 0.1 else said[:4]} {said[:9]}."))
        marks.append((i, 0, toxic))
    wrong, pairs = [], []
    for groups in ({}, {lang: toxicity.IDENTITY_TERMS[lang]}):
        got = toxicity.classify(docs(spark, rows), labels(spark, marks), groups=groups, counterfactual=50.0).collect()
        clean = [r for r in got if r.held_out and r.doc_id % 2 == 0]
        wrong.append(np.mean([r.predicted for r in clean]))
        pairs.append(got[0].n_pairs)
    assert pairs[0] == 0 and pairs[1] > 200
    assert wrong[0] > 0.5 and wrong[1] < 0.1


def test_toxic_texts_are_caught_and_clean_ones_left(spark):
    found = toxicity.classify(table(spark, SF1, "documents"), table(spark, SF1, "labels"))
    rows = found.join(table(spark, SF1, "labels").select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted for r in rows if r.toxic == 1]) >= 0.85
    assert np.mean([r.predicted for r in rows if r.toxic == 0]) <= 0.02
    assert all(r.n_pairs > 0 for r in rows)


def test_forest_walk_follows_its_arrays():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(800, 5))
    y = ((x[:, 1] > 0.3) & (x[:, 3] < 0.5)).astype(float)
    forest = quality.grow(x[:500], y[:500], trees=30)
    got = quality.walk(forest, x[500:])
    assert np.mean((got >= 0.5) == y[500:]) > 0.95

    def one(row):
        total = 0.0
        for t in range(30):
            node = 0
            for _ in range(int(forest["depth"])):
                f = forest["feature"][t, node]
                node = 2 * node + 1 + int(f >= 0 and row[f] > forest["threshold"][t, node])
            total += forest["value"][t, node]
        return 1 / (1 + np.exp(-total))

    np.testing.assert_allclose(got[:20], [one(r) for r in x[500:520]], rtol=1e-12)
