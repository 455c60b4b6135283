"""The pipeline's stages, each against what its operator says of the stage's own input."""

import collections

import corpus_pipeline
from conftest import SF001
from llm.test_copies import plain_components
from llm.test_text import plain_contamination
from tablestats.llm import mixing, toxicity
from tablestats.llm.common import table, written


def test_stages(spark):
    docs = table(spark, SF001, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF001), name)
        seen[name] = (before, docs)
        if name != "sharding":
            assert docs.columns == columns
    pairs = {n: ([(r.doc_id, r.text) for r in a.collect()], b.collect()) for n, (a, b) in seen.items()}

    before, after = seen["toxicity"]
    scores = toxicity.classify(before, table(spark, SF001, "labels"))
    assert {r.doc_id for r in scores.where("predicted = 0").collect()} == {r.doc_id for r in after.collect()}

    rows, kept = pairs["near_duplicates"]
    want = plain_components(rows, 5, 80)
    assert sorted(r.doc_id for r in kept) == sorted({c for _, _, c in want})

    rows, kept = pairs["decontamination"]
    items = [(r.item_id, r.text) for r in table(spark, SF001, "benchmark").collect()]
    assert sorted(r.doc_id for r in kept) == sorted(r[0] for r in plain_contamination(rows, items) if not r[-1])

    rows, kept = pairs["mixing"]
    times = collections.Counter(r.doc_id for r in kept)
    assert max(times.values()) <= 3
    words = {d: len(t.split()) for d, t in rows}
    mix = mixing.mix(seen["mixing"][0])[0].collect()
    largest = max(words.values())
    for source in {r.source for r in mix}:
        own = [r for r in mix if r.source == source]
        assert abs(sum(times[r.doc_id] * words[r.doc_id] for r in own) - own[0].target) <= largest

    rows, shards = pairs["sharding"]
    sizes = collections.Counter(r.shard for r in shards)
    assert sum(sizes.values()) == len(rows) and max(sizes.values()) - min(sizes.values()) <= 1
