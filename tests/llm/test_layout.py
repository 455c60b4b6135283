"""Sharding and mixing: quotas, targets, edge tables."""

import random
from fractions import Fraction

import pytest

from llm.helpers import awkward, docs
from tablestats.llm import mixing, sharding


def by_shard(rows):
    out = {}
    for r in rows:
        out.setdefault(r["shard"], []).append(r)
    return out


def test_shards_even_gapless_and_groups_together(spark):
    rng = random.Random(1)
    texts = [f"text {rng.randrange(150)}" for _ in range(400)] + [f"alone {i}" for i in range(211)]
    rows = sharding.shard_documents(docs(spark, list(enumerate(texts)))).collect()
    shards = by_shard(rows)
    sizes = [len(v) for v in shards.values()]
    assert sum(sizes) == 611 and len(sizes) == 8 and max(sizes) - min(sizes) <= 1
    for v in shards.values():
        assert sorted(r["slot"] for r in v) == list(range(len(v)))
    homes = {}
    for r in rows:
        homes.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    assert sum(len(s) > 1 for s in homes.values()) <= 3
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in rows)


def test_hot_group_spills_over_few_shards(spark):
    texts = ["same"] * 300 + [f"alone {i}" for i in range(500)]
    rows = sharding.shard_documents(docs(spark, list(enumerate(texts)))).collect()
    assert {len(v) for v in by_shard(rows).values()} == {100}
    held = sorted((sum(texts[r["doc_id"]] == "same" for r in v) for v in by_shard(rows).values()), reverse=True)
    assert held[0] == 100  # one shard is filled with it


def test_hot_group_and_pairs_lie_on_as_few_shards_as_can_be(spark):
    texts = ["same"] * 1600 + [f"pair {i // 2}" for i in range(1600)] + [f"alone {i}" for i in range(1600)]
    rows = sharding.shard_documents(docs(spark, list(enumerate(texts)))).collect()
    assert {len(v) for v in by_shard(rows).values()} == {600}
    homes = {}
    for r in rows:
        homes.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    assert len(homes["same"]) == 3
    assert sum(len(s) > 1 for t, s in homes.items() if t != "same") <= 16


def test_hot_groups_fill_shards_one_after_another():
    room = [10, 10, 10, 10]
    got = sharding._heavy_places([(b"a", [5, 5, 5, 8]), (b"b", [0, 6, 0, 0]), (b"c", [0, 0, 3, 4])], room)
    assert sum(room) == 4 and min(room) >= 0
    for link, n, most in ((b"a", 23, 3), (b"b", 6, 1), (b"c", 7, 1)):
        mine = [p for p in got if p[0] == link]
        assert sum(p[2] - p[1] for p in mine) == n and len(mine) <= most


def test_shards_of_awkward_and_empty_tables(spark):
    rows = sharding.shard_documents(docs(spark, awkward())).collect()
    assert len(rows) == 12
    null = [r for r in rows if r["doc_id"] == 1][0]
    assert (null["size"], null["text_crc32"]) == (1, 0)
    assert sharding.shard_documents(docs(spark, [])).count() == 0


def community_graph(n=400, size=20, seed=2):
    """Edges of a graph that is no set of cliques: rings with chords, and a few links between rings."""
    rng, edges = random.Random(seed), set()
    for c in range(0, n, size):
        ring = list(range(c, c + size))
        edges |= {(a, b) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)}
        edges |= {tuple(rng.sample(ring, 2)) for _ in range(2 * size)}
    edges |= {(rng.randrange(n), rng.randrange(n)) for _ in range(n // 20)}
    return sorted({(min(e), max(e)) for e in edges if e[0] != e[1]})


def graph_nodes(spark, n, edges):
    links = {i: [] for i in range(n)}
    for a, b in edges:
        for i in (a, b):
            links[i].append(f"edge {a} {b}".encode())
    return spark.createDataFrame([(i, f"own {i}".encode(), links[i]) for i in range(n)],
                                 "doc_id long, link binary, links array<binary>")


def test_propagation_cuts_fewer_edges_of_a_graph(spark):
    n, edges = 400, community_graph()
    nodes = graph_nodes(spark, n, edges)
    report = [tuple(r) for r in sharding.propagation_report(nodes, rounds=12).orderBy("round").collect()]
    assert [r[0] for r in report] == list(range(len(report))) and len(report) > 2
    assert all(r[2] == len(edges) for r in report) and report[-1][3] == 0
    first, last = report[0][1], report[-1][1]
    rows = sharding.propagate(nodes, rounds=12).collect()
    home = {r["doc_id"]: r["shard"] for r in rows}
    cut = sum(home[a] != home[b] for a, b in edges)
    assert {len(v) for v in by_shard(rows).values()} == {50}
    assert last < 0.75 * first and cut < 0.8 * first, (report, cut)


def test_report_counts_cut_pairs(spark):
    texts = ["a"] * 5 + ["b"] * 3 + ["c"] + [None] * 2
    nodes = docs(spark, list(enumerate(texts))).select("doc_id", sharding.equal_text_key().alias("link"))
    state, labels, report = sharding._labelled(nodes, 4, 0)
    home = {r["doc_id"]: r["shard"] for r in state.join(labels, "row").collect()}
    pairs = [(a, b) for a in range(11) for b in range(a) if texts[a] == texts[b]]
    assert report == [(0, sum(home[a] != home[b] for a, b in pairs), len(pairs), 0)]


def test_hot_keys_meet_no_single_task_and_none_is_lost(spark):
    nodes = spark.createDataFrame([(i % 7, b"hub" if i % 3 == 0 else f"x{i}".encode(), [b"all", None, b"all"])
                                   for i in range(600)], "doc_id long, link binary, links array<binary>")
    rows = sharding.propagate(nodes).collect()
    assert len(rows) == 600 and {len(v) for v in by_shard(rows).values()} == {75}
    assert sorted(r["slot"] for r in rows if r["shard"] == 0) == list(range(75))
    assert len({r["shard"] for r in rows if r["link"] == b"hub"}) == 3


@pytest.mark.parametrize("seed", range(3))
def test_admitted_moves_stay_within_the_room(seed):
    rng = random.Random(seed)
    wanted = [[rng.randrange(100) * (a != b) for b in range(6)] for a in range(6)]
    room = [rng.randrange(-5, 40) for _ in range(6)]
    share = sharding._admitted(wanted, room)
    for s in range(6):
        into = sum(wanted[a][s] * share[a][s] for a in range(6))
        out = sum(wanted[s][b] * share[s][b] for b in range(6))
        assert into <= max(room[s] + out, 0) + 1
    assert sum(map(sum, share)) > 1


@pytest.mark.parametrize("seed", range(5))
def test_sainte_lague_is_sequential(seed):
    rng = random.Random(seed)
    weights = [rng.choice([0, 1, 5, 5, 17.5, 100]) for _ in range(7)] + [1]
    for seats in (0, 1, 5, 37, 200):
        held = [0] * len(weights)
        for _ in range(seats):
            i = max(range(len(weights)), key=lambda i: (Fraction(weights[i]) / (2 * held[i] + 1), -i))
            held[i] += 1
        assert mixing.sainte_lague(weights, seats) == held
    quotas = mixing.shard_quotas(weights, 200, 8)
    assert [sum(q[i] for q in quotas) for i in range(len(weights))] == mixing.sainte_lague(weights, 200)
    assert all(x >= 0 for q in quotas for x in q) and {sum(q) for q in quotas} == {25}


def test_targets_stop_at_three_times_the_size():
    got = mixing.capped_targets([1000, 10, 0, 500], [1, 2, 3, 1])
    assert got[1] == 30 and got[2] == 0 and abs(sum(got) - 1510) < 1e-9
    assert got[0] == got[3] == 740


def test_mix_comes_near_targets(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(0, 90)), rng.choice(["b", "a", "c", None, "hot", "hot", "hot"]))
            for i in range(500)]
    got, quotas = mixing.mix(docs(spark, rows))
    got = got.collect()
    assert len(got) == 500 and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    sums = {}
    for r in got:
        s = sums.setdefault(r["source"], [0, 0, r["target"], r["source_size"]])
        s[0] += r["size"]
        s[1] += r["taken"]
    assert abs(sum(s[2] for s in sums.values()) - sum(r["size"] for r in got)) < 1e-6
    for size, taken, target, said in sums.values():
        assert size == said and abs(taken - target) <= mixing.BLOCK_TOKENS
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(docs(spark, rows[::-1]))[0].collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}
    assert quotas.groupBy("source").sum("blocks").count() == 5


@pytest.mark.parametrize("shards", [1, 5])
def test_blocks_of_a_shard_match_its_quota(spark, shards):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(0, 200)), rng.choice(["a", "b", None, "hot", "hot"])) for i in range(300)]
    got, quotas = mixing.mix(docs(spark, rows), shards=shards)
    got = sorted(got.collect(), key=lambda r: (str(r["source"]), r["position"], r["size"]))
    want = {(r["source"], r["shard"]): r["blocks"] for r in quotas.collect()}
    for source in ("a", "b", None, "hot"):
        key = "~" if source is None else "=" + source
        mine = [r for r in got if r["source"] == source]
        line = [r["doc_id"] for r in mine for _ in range(r["size"])]  # word by word
        reach, at = sum(r["taken"] for r in mine), 0
        for shard in range(shards):
            end = min(at + want[key, shard] * mixing.BLOCK_TOKENS, mixing.CAP * len(line))
            held = {}
            for word in range(at, end):
                held[line[word % len(line)]] = held.get(line[word % len(line)], 0) + 1
            assert {r["doc_id"]: r["shard_words"][shard] for r in mine if r["shard_words"][shard]} == held
            at = end
        assert at == reach
    assert all(sum(r["shard_words"]) == r["taken"] for r in got)


def test_mix_of_awkward_and_empty_tables(spark):
    got, _ = mixing.mix(docs(spark, awkward()))
    assert got.count() == 12 and got.where("doc_id = 1 and taken <> 0").count() == 0
    table = docs(spark, awkward())
    assert mixing.mixed(table).columns == table.columns
    assert mixing.mix(docs(spark, []))[0].count() == 0
    assert mixing.mixed(docs(spark, [])).count() == 0
