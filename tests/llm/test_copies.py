"""Substring removal, fingerprints and the Jaccard join against plain versions."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from llm.helpers import awkward, docs, vocabulary_texts
from tablestats.llm import fingerprints, jaccard_join, suffix_dedup


def plain_removal(rows, span=100):
    """Rows in order of id; returns id -> (bytes, removed, spans, digest)."""
    seen, out = set(), {}
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - span + 1):
            w = raw[i:i + span]
            if w in seen:
                gone[i:i + span] = True
            seen.add(w)
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(raw) else 0
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out[doc_id] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def removal_rows():
    rng = random.Random(9)
    shared = ["".join(rng.choice("abcdef ") for _ in range(n)) for n in (90, 99, 100, 101, 160, 400)]
    rows = []
    for i in range(60):
        own = "".join(rng.choice("ghijkl é") for _ in range(rng.randint(0, 250)))
        rows.append((i, own + rng.choice(shared) + own[:rng.randint(0, 120)] + rng.choice(["", rng.choice(shared)])))
    line = "".join(rng.choice("mnop") for _ in range(130))
    rows += [(60 + i, line + f" tail {i} " + line[:i * 3]) for i in range(40)]  # many contexts of one anchor
    rows += [(100, "ab" * 300), (101, "x" * 500), (102, "x" * 99), (103, None), (104, ""), (105, rows[3][1])]
    return rows


@pytest.mark.parametrize("shard_classes,shard_bytes", [(4000, 2_000_000), (7, 3000)])
def test_removal_matches_plain_version(spark, shard_classes, shard_bytes):
    rows = removal_rows()
    got = suffix_dedup.deduplicated(docs(spark, rows).repartition(5, "doc_id"), shard_classes=shard_classes,
                                    shard_bytes=shard_bytes).collect()
    assert {r.doc_id: tuple(r)[1:5] for r in got} == plain_removal(rows) and len(got) == len(rows)


def test_removal_on_awkward_tables(spark):
    got = suffix_dedup.deduplicated(docs(spark, awkward())).collect()
    assert len(got) == 12 and sum(r.n_bytes for r in got if r.doc_id == 1) == 0
    assert suffix_dedup.deduplicated(docs(spark, [])).count() == 0


@pytest.mark.parametrize("alphabet,n", [("a", 300), ("ab", 400), ("abcdefgh", 500)])
def test_suffix_array_and_common_prefixes(alphabet, n):
    rng = random.Random(n)
    data = "".join(rng.choice(alphabet) for _ in range(n)).encode()
    order, _ = suffix_dedup.suffix_array(np.frombuffer(data, np.uint8), 100)
    cut = [data[i:i + 100] for i in order]
    assert sorted(order) == list(range(n)) and cut == sorted(cut)
    shared = suffix_dedup.common_prefixes(data, order, 100)
    for k in range(1, n):
        a, b = data[order[k - 1]:], data[order[k]:]
        want = next((i for i in range(min(len(a), len(b), 100)) if a[i] != b[i]), min(len(a), len(b), 100))
        assert shared[k] == want


def test_fingerprints(spark):
    rows = awkward()[:5] + awkward()[7:] + [(i, t) for i, t in enumerate(vocabulary_texts(120, 8, words=900), 100)]
    rows += [(300, rows[-1][1])]
    got = fingerprints.fingerprints(docs(spark, rows), partitions=4).collect()
    assert len(got) == len(rows)
    order = sorted(set(rows), key=lambda r: -r[0])
    for i, (doc_id, text) in enumerate(order):
        text, nxt = text or "", order[(i + 1) % len(order)][1] or ""
        mine = [r for r in got if r.doc_id == doc_id and r.n_chars == len(text)]
        edited = text[:len(text) - len(text) // 2] + nxt[:len(text) // 2]
        if doc_id != 4:  # that one stands twice: its neighbour is its copy
            assert mine[0].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in mine)
    prints = {}
    for r in got:
        prints.setdefault(dict(rows)[r.doc_id], set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    many = [r for r in got if r.doc_id and 100 <= r.doc_id < 300]
    assert np.mean([r.near_edited for r in many]) > 5 * np.mean([r.near_next for r in many])
    assert fingerprints.fingerprints(docs(spark, []), partitions=2).count() == 0
    one = fingerprints.fingerprints(docs(spark, [(None, "alone here")]), partitions=3).first()
    assert one.doc_id is None and one.near_next == 1.0


def plain_components(rows, width, percent):
    def shingles(text):
        w = (text or "").encode().lower().split()
        if not w:
            return frozenset()
        return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in groups[find(i)] if x is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return out


def near_rows(seed):
    rng = random.Random(seed)
    rows, line = [], " ".join(f"line{i}" for i in range(25))
    for i in range(12):
        base = vocabulary_texts(1, seed * 50 + i, words=500, least=8, most=90)[0].split()
        for _ in range(rng.randint(1, 7)):
            t = list(base)
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = f"n{rng.randrange(50)}"
            if rng.random() < 0.3:
                t += ["extra"] * rng.randint(1, 3)
            rows.append((rng.randrange(10_000), " ".join(t)))
    rows += [(20_000 + i, line + f" own{i} word{i} here{i}") for i in range(20)]  # mostly a common line
    return list({r[0]: r for r in rows}.values())


@pytest.mark.parametrize("seed,width,percent,labels", [(1, 3, 90, 64), (2, 3, 90, 0), (3, 5, 80, 1)])
def test_join_matches_plain_version(spark, seed, width, percent, labels):
    rows = near_rows(seed) + awkward()
    got = jaccard_join.linked(docs(spark, rows), width=width, percent=percent, frequent_labels=labels)
    key = lambda r: tuple((x is None, x) for x in r)
    want = sorted(plain_components(rows, width, percent), key=key)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()), key=key) == want
    if seed == 1:
        table = docs(spark, rows).coalesce(1)
        kept = jaccard_join.one_of_each(table, width=width, percent=percent)
        assert kept.columns == table.columns
        empty = sum(r[1] == 0 for r in want)
        groups = {r[2] for r in want if r[1]}
        assert kept.count() == empty + len(groups)


def test_join_of_empty_table(spark):
    assert jaccard_join.linked(docs(spark, [])).count() == 0


def test_group_of_near_copies_forms_few_candidates(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(300):
        text = list(base)
        for at in rng.sample(range(200), 2 if i % 10 == 0 else 8):  # linked with the base, or just not
            text[at] = f"x{i}_{at}"
        rows.append((i, " ".join(text)))
    asked, verified = [], jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, *how: asked.append(pairs.count()) or verified(pairs, *how))
    got = jaccard_join.linked(docs(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(tuple(r) for r in got) == sorted(plain_components(rows, 3, 90))
    assert len({r.component_id for r in got}) > 200 and sum(asked) < 5 * len(rows)


@pytest.mark.parametrize("n", [1, 12, 300, 20_000])
def test_sketches_never_differ_in_more_bits_than_the_sets(n):
    rng = np.random.default_rng(n)
    a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
    for changed in (0, n // 20, n // 3, n):
        b = np.unique(np.concatenate([a[changed:], rng.integers(0, 2**63, changed // 2, dtype=np.uint64)]))
        apart = sum(int(x ^ y).bit_count() for x, y in zip(*(jaccard_join.sketch(t).view(np.uint64).tolist() for t in (a, b)),
                                                           strict=True))
        assert apart <= len(np.setxor1d(a, b))


def test_prefix_keeps_one_common_signature():
    rng = np.random.default_rng(4)
    bitmap = rng.integers(0, 256, 1 << 21, dtype=np.uint8) | rng.integers(0, 256, 1 << 21, dtype=np.uint8)
    for _ in range(300):
        n = int(rng.integers(9, 120))
        base = rng.integers(0, 2**63, n, dtype=np.uint64)
        other = base.copy()
        other[:jaccard_join.slack(n) // 2] = rng.integers(0, 2**63, jaccard_join.slack(n) // 2, dtype=np.uint64)
        a, b = np.unique(base), np.unique(other)
        both = len(np.intersect1d(a, b))
        if 100 * both >= 90 * (len(a) + len(b) - both):
            x, _ = jaccard_join.signatures(a, bitmap, 90)
            y, _ = jaccard_join.signatures(b, bitmap, 90)
            assert len(np.intersect1d(x, y))


def test_runs_without_a_repeated_flank_send_nothing(spark, monkeypatch):
    rng = random.Random(11)
    phrase = "a phrase of fifty bytes which many documents hold."
    def some(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    rows = [(i, some(300) + phrase + some(300)) for i in range(40)]
    rows += [(100, some(200) + "x" * 150), (101, rows[0][1][250:420] + some(200))]
    found, whole = [], suffix_dedup._found_runs
    monkeypatch.setattr(suffix_dedup, "_found_runs", lambda *a: found.append(whole(*a)) or found[-1])
    got = {r.doc_id: r.n_removed for r in suffix_dedup.deduplicated(docs(spark, rows)).collect()}
    assert {k for k, v in got.items() if v} == {100, 101} and got[101] >= 170
    assert {r.doc for r in found[0].select("doc").distinct().collect()} <= {0, 100, 101}


@pytest.mark.parametrize("span, gram", [(100, 32), (9, 4), (8, 3), (6, 6)])
def test_windows_that_repeat_share_a_flank(span, gram):
    rng = np.random.default_rng(5)
    for _ in range(30):
        shared = rng.integers(97, 100, span + int(rng.integers(0, 20)))
        a, b = (np.concatenate([rng.integers(97, 123, rng.integers(0, 150)), shared, rng.integers(97, 123, rng.integers(0, 150))]).astype(np.uint8)
                for _ in range(2))
        (x, _, _, x_again, _, (i, p)), (y, _, _, y_again, _, (j, q)) = (suffix_dedup.runs(d, span, gram) for d in (a, b))
        same = np.intersect1d(x, y)
        assert len(same)
        window = bytes(shared[:span].astype(np.uint8))
        anchor = suffix_dedup.runs(np.frombuffer(window, np.uint8), span, gram)[0][0]
        own, other = ({int(k) for r, k in zip(run, keys, strict=True) if anchors[r] == anchor} for anchors, run, keys in ((x, i, p), (y, j, q)))
        assert own & other


def test_a_shard_is_sorted_in_pieces_of_whole_anchors(monkeypatch):
    rng = np.random.default_rng(8)
    rows, uid = [], 0
    for anchor in range(300):
        shared = rng.integers(97, 123, 120, dtype=np.uint8).tobytes()
        for j in range(int(rng.integers(2, 40))):
            own = rng.integers(97, 123, int(rng.integers(1, 60)), dtype=np.uint8).tobytes() + bytes([128 + j])
            rows.append((0, False, anchor, uid, uid, 7, own + shared))
            uid += 1
    pdf = pd.DataFrame(rows, columns=["shard", "split", "anchor", "doc", "uid", "lo", "context"])
    held, whole = [], suffix_dedup.window_groups
    monkeypatch.setattr(suffix_dedup, "window_groups", lambda c, span: held.append(sum(map(len, c))) or whole(c, span))
    got = suffix_dedup._sort_shard(100)(pdf.sample(frac=1, random_state=1))
    assert sum(held) == pdf["context"].str.len().sum() > 800_000 and max(held) <= 1 << 18
    later = pdf[pdf["anchor"].duplicated()]
    size = later["context"].str.len()
    want = sorted(zip(later["uid"], size - 120 + 7, size + 7, strict=True))
    assert sorted(got[["uid", "lo", "hi"]].itertuples(index=False, name=None)) == want


def test_few_long_contexts_of_one_anchor_are_split_by_their_bytes(spark, monkeypatch):
    rows = [(i, "x" * (3000 + i)) for i in range(12)]
    held, sort = [], suffix_dedup._contexts
    monkeypatch.setattr(suffix_dedup, "_contexts", lambda r: held.append(sort(r)) or held[-1])
    got = suffix_dedup.deduplicated(docs(spark, rows), shard_bytes=9000).collect()
    assert {r.doc_id: tuple(r)[1:5] for r in got} == plain_removal(rows)
    sizes = held[0].groupBy("shard").agg(F.sum(F.length("context")).alias("n")).collect()
    assert sum(r["n"] for r in sizes) > 36_000 and max(r["n"] for r in sizes) < 27_000


def test_subset_hashes_are_the_sums_of_their_members(monkeypatch):
    rng = np.random.default_rng(3)
    lexicon, mixes, mix = np.full(1 << (fingerprints.SLOT_BITS - 3), 255, np.uint8), [], fingerprints._mix
    monkeypatch.setattr(fingerprints, "_mix", lambda x: mixes.append(1) or mix(x))
    for n in (1, 2, 7, 300, 3000):
        hashes = np.sort(rng.integers(0, 2**64, n, dtype=np.uint64))
        got = fingerprints.fingerprint("", hashes, lexicon)[4:].reshape(len(fingerprints.RATES), fingerprints.SUBSETS)
        for i, bits in enumerate(fingerprints.RATES):
            for j, seed in enumerate(fingerprints._SEEDS):
                members = [int(d) for d in mix(hashes ^ seed) if int(d) >> (64 - bits) == 0]
                total = np.array([sum(members) * int(fingerprints._ODD) % 2**64], np.uint64)
                assert got[i, j] == (int(mix(total)[0]) & 0xFFFF | 1 if members else 0)
    assert len(mixes) == 2 * 5  # draws and sums, each once a text


def test_sets_with_enough_tokens_of_their_own_are_not_indexed_by_a_shared_passage(spark, monkeypatch):
    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(300))
    rows = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(450)) + " " + passage) for i in range(20)]
    rows += [(50, rows[3][1] + " more"), (51, rows[7][1].replace("p250", "q250"))]
    sizes, whole = {}, jaccard_join.written

    def watched(df, name, by=()):
        out = whole(df, name, by)
        sizes.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "written", watched)
    got = sorted(map(tuple, jaccard_join.linked(docs(spark, rows), percent=80).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == sorted(plain_components(rows, 3, 80))
    assert sum(sizes["mixed"]) <= 200  # 22 sets with some 60 tokens of the passage in their prefixes


def test_entries_with_the_same_rows_are_one(spark, monkeypatch):
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(300))
    rows = [(i, " ".join(f"w{rng.randrange(10**9)}" for _ in range(450)) + " " + passage) for i in range(3)]
    sizes, whole = [], jaccard_join.written

    def watched(df, name, by=()):
        out = whole(df, name, by)
        if name == "mixed":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "written", watched)
    got = sorted(map(tuple, jaccard_join.linked(docs(spark, rows), percent=60).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == sorted(plain_components(rows, 3, 60))
    assert sizes and 0 < sizes[0] <= 9


def test_wide_sketches_differ_by_no_more_than_the_sets(spark):
    rng, pairs = np.random.default_rng(8), []
    for n in (200, 257, 500, 512, 513, 900, 1030, 3000):
        for drop in (0, 1, n // 20, n // 5, n // 2):
            a = rng.integers(0, 2**63, n, dtype=np.uint64)
            b = np.concatenate([a[drop:], rng.integers(0, 2**63, drop // 2, dtype=np.uint64)])
            pairs.append((*(jaccard_join.wide_sketch(t).tolist() for t in (a, b)), len(np.setxor1d(a, b))))
    df = spark.createDataFrame(pairs, "wide array<long>, other_wide array<long>, d long")
    got = df.select(jaccard_join._wide_apart().alias("apart"), "d", F.size("wide").alias("s")).collect()
    assert all(r.apart <= r.d for r in got) and any(r.s and r.apart > 100 for r in got)
    assert all(r.apart % 2 == r.d % 2 for r in got if r.s and r.apart)
