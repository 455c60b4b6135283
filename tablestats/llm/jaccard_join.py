"""N-gram Jaccard join with token-combination prefixes.

Documents are sets of hashed word shingles; two link if their Jaccard
similarity reaches a threshold.  Tokens are ordered by class (rare before
frequent) and hash.  A set of n tokens can miss ``slack`` of them in a partner,
so its prefix runs until rare tokens + (frequent tokens - 1) exceed ``slack``:
two linked sets then share a rare token of both prefixes, or two frequent ones.
Rare tokens are indexed alone, frequent ones as pairs; candidates are verified on
the whole sets.

A frequent token is one in the prefixes of many unlike documents, a shared token one in
those of several.  Shared tokens stand behind the other rare ones, so a set with enough
tokens of its own isn't indexed by a passage that others hold too.  The classes are
bits of fixed bitmaps (2 MB each, broadcast), so they are the same for all sets; bits
that tokens share make a rare token shared or frequent, which loses nothing.

Groups: documents with equal sets are one class from the start (a shuffle with
partial aggregation, however many copies).  Classes that share their smallest
token (by any of ``LABELS`` hashes) are verified against the one of them with most
copies, which joins large groups of near copies by a few pairs a member.  Candidate pairs are then only formed between
different components: in each index entry the rows outside of its largest
component meet all others.  Entries that hold the same rows, as those of a passage in
several documents do, are one entry with a count.  A pair must share as many entries as the sizes of
the remainders demand before any set is read for it.

Every set carries a sketch of ``SKETCH`` bits, the parities of its tokens by hash.
Two sketches differ in at most as many bits as the sets differ in tokens, so a
pair whose sketches differ by more than the threshold allows is left out where the
rows meet, before a row is made for it; no link can be lost by that.  Candidates
are verified in two rounds: the pair with the nearest sketches of each two
components, then, of what still lies in different components, all.

Scale: texts are read where they lie; sets are built for candidates alone, and
for those the ids are broadcast within ``BROADCAST_ROWS`` or else shuffled.  The
skewed joins (a pivot, a common token) are plain sort-merge joins that Spark splits
at run time.

Defined cases: fewer words than a shingle make one token of the whole sequence;
a text without words, null or empty, has no tokens and links with nothing; rows
that repeat are linked; a null id is never the smallest; no documents gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestats.llm.common import dropped, small_batches, small_side, written

WIDTH = 3
PERCENT = 90
LABELS = 3
FREQUENT_LABELS = 64
SHARED_LABELS = 8
FREQUENT_TOKENS = 1 << 20
CLASS_BITS = 24
SKETCH = 256
WIDE = 2048
_BITMAP_BITS = 1 << 15
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


_SEEDS = _mix(np.arange(1, LABELS + 1, dtype=np.uint64) * _ODD)


class Shingler:
    """Sorted distinct 64-bit hashes of a text's shingles (words remembered up to a bound)."""

    def __init__(self, width: int = WIDTH, memory: int = 100_000):
        self.width, self.memory, self.seen = width, memory, {}

    def __call__(self, text: str | None) -> np.ndarray:
        found, seen = (text or "").encode("utf-8", "surrogatepass").lower().split(), self.seen
        if not found:
            return np.empty(0, np.uint64)
        if len(seen) > self.memory:
            seen.clear()
        for w in [w for w in set(found) if w not in seen]:
            seen[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter((seen[w] for w in found), np.uint64, len(found))
        width = min(self.width, len(h))
        out = np.full(len(h) - width + 1, np.uint64(width))
        for i in range(width):
            out = _mix(out * _ODD + h[i:len(h) - width + 1 + i])
        return np.unique(out)


def sketch(tokens: np.ndarray, bits: int = SKETCH) -> np.ndarray:
    """Whether an odd number of tokens falls on each of ``bits`` bits, as longs."""
    odd = np.bincount((tokens % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_sketch(tokens: np.ndarray) -> np.ndarray:
    """A sketch of as many bits as there are tokens (the next power of two, ``WIDE`` at most); none for small sets."""
    if len(tokens) <= SKETCH:
        return np.empty(0, np.int64)
    return sketch(tokens, min(WIDE, 1 << (len(tokens) - 1).bit_length()))


_MARKS = [f"mark{i}" for i in range(SKETCH // 64)]


def slack(n: int, percent: int = PERCENT) -> int:
    """How many of n tokens can be missing in a partner."""
    return n + (-percent * n // 100)


def class_prefix(tokens: np.ndarray, frequent: np.ndarray, percent: int = PERCENT,
                 shared: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rare and frequent tokens of the prefix; ``tokens`` sorted, ``frequent`` their bits.

    Rare tokens with a bit in ``shared`` come after those without."""
    need = slack(len(tokens), percent) + 1
    rare, common = tokens[~frequent], tokens[frequent]
    if shared is not None:
        later = shared[~frequent]
        rare = np.concatenate([rare[~later], rare[later]])
    rare = rare[:need]
    if len(rare) >= need:
        return rare, common[:0]
    return rare, common[:need - len(rare) + 1]


def _bits(tokens: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    slots = (tokens >> np.uint64(64 - CLASS_BITS)).astype(np.int64)
    return (bitmap[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def signatures(tokens: np.ndarray, bitmap: np.ndarray, percent: int,
               shared: np.ndarray | None = None) -> tuple[np.ndarray, int]:
    """Index entries of a set, and how many tokens lie behind its prefix.  Bitmaps: of frequent and of shared tokens.

    With pairs among the entries the second value is the whole size: shared
    entries then say nothing about shared tokens."""
    rare, common = class_prefix(tokens, _bits(tokens, bitmap), percent, None if shared is None else _bits(tokens, shared))
    if not len(common):
        return rare, len(tokens) - len(rare)
    a, b = np.triu_indices(len(common), 1)
    return np.concatenate([rare, _mix(common[a] * _ODD + common[b])]), len(tokens)


def least_size(percent: int) -> int:
    """Smaller sets link with equal ones only."""
    n = 1
    while 100 * n < percent * (n + 1):
        n += 1
    return n


def _front(n: int, percent: int) -> int:
    """How many of the smallest tokens are kept: a prefix, and some in place of frequent ones."""
    need = slack(n, percent) + 1
    return need + need // 4 + 8


def _sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``uid, doc_id, n, key, labels, front, wide, mark0..``: set size, set hash, smallest token by each of
    ``LABELS`` hashes, first tokens, wide sketch, sketch."""
    least = least_size(percent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(width)
        for batch in batches:
            n, key, labels, front, marks, wide = [], [], [], [], [], []
            for uid, text in zip(batch["uid"], batch["text"], strict=True):
                s = shingles(text)
                n.append(len(s))
                key.append(hashlib.blake2b(s.tobytes() if len(s) else b"%d" % uid,
                                           digest_size=16, person=b"set" if len(s) else b"none").digest())
                labels.append([int(_mix(s ^ seed).min().astype(np.int64)) for seed in _SEEDS] if len(s) else [])
                front.append(s[:_front(len(s), percent)].view(np.int64) if len(s) >= least else [])
                marks.append(sketch(s))
                wide.append(wide_sketch(s) if len(s) >= least else [])
            marks = np.array(marks, np.int64).reshape(len(n), len(_MARKS))
            yield pd.DataFrame({"uid": batch["uid"], "doc_id": batch["doc_id"], "n": n, "key": key,
                                "labels": labels, "front": front, "wide": wide}).assign(**dict(zip(_MARKS, marks.T, strict=True)))

    return docs.mapInPandas(run, "uid long, doc_id long, n int, key binary, labels array<long>, front array<long>, wide array<long>, "
                                 + ", ".join(f"{m} long" for m in _MARKS))


def _held_by_many(classes: DataFrame, *labels: int) -> list[np.ndarray]:
    """For each of ``labels`` a bitmap of the tokens in the prefixes of more groups of like documents."""
    # Sixteen bits of the label tell groups apart well enough to count to ``labels``.
    tokens = (classes.select(F.explode("front").alias("token"), F.get("labels", 0).bitwiseAND(0xFFFF).alias("label")).distinct()
              .groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") > min(labels)))
    tokens = written(tokens, "frequent")
    slot = F.shiftrightunsigned("token", 64 - CLASS_BITS).cast("int")
    out = []
    for most in labels:
        while tokens.where(F.col("n") > most).count() > FREQUENT_TOKENS:
            most *= 2  # the bitmap must stay mostly empty
        rows = (tokens.where(F.col("n") > most).select(slot.alias("slot"))
                .groupBy(F.floor(F.col("slot") / _BITMAP_BITS).alias("b"))
                .agg(F.bitmap_construct_agg(F.col("slot") % _BITMAP_BITS).alias("bits")).collect())
        bitmap = np.zeros(1 << (CLASS_BITS - 3), np.uint8)
        for r in rows:
            at = r["b"] * _BITMAP_BITS // 8
            bitmap[at:at + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
        out.append(bitmap)
    return out


def _texts_of(docs: DataFrame, uids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``uid`` is in ``uids`` (with the columns of ``uids``)."""
    return docs.select("uid", "text").join(small_side(uids, uids.count()), "uid")


def _index(docs: DataFrame, classes: DataFrame, bitmaps, width: int, percent: int) -> DataFrame:
    """``sig, uid, n, rest`` per class; sets with few rare tokens that aren't shared are read again in full."""
    def from_front(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent, shared = bitmaps.value
        for batch in batches:
            sig, rest = [], []
            for n, front in zip(batch["n"], batch["front"], strict=True):
                tokens = np.asarray(front, np.int64).view(np.uint64)
                rare = tokens[~(_bits(tokens, frequent) | _bits(tokens, shared))][:slack(n, percent) + 1]
                whole = len(rare) > slack(n, percent)
                sig.append(rare.view(np.int64) if whole else [])
                rest.append(n - len(rare) if whole else -1)
            yield pd.DataFrame({"uid": batch["uid"], "n": batch["n"], "sig": sig, "rest": rest})

    def from_text(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, (frequent, shared) = Shingler(width), bitmaps.value
        for batch in batches:
            for uid, n, text in zip(batch["uid"], batch["n"], batch["text"], strict=True):
                sig, rest = signatures(shingles(text), frequent, percent, shared)
                for i in range(0, len(sig), 1 << 16):
                    yield pd.DataFrame({"uid": [uid], "n": [n], "sig": [sig[i:i + (1 << 16)].view(np.int64)],
                                        "rest": [rest]})

    near = written(classes.select("uid", "n", "front").mapInPandas(
        from_front, "uid long, n int, sig array<long>, rest int"), "near")
    far = _texts_of(docs, near.where("rest < 0").select("uid", "n")).select("uid", "n", "text").mapInPandas(
        from_text, "uid long, n int, sig array<long>, rest int")
    both = near.where("rest >= 0").select("uid", "n", "sig", "rest").unionByName(far)
    return both.select(F.explode("sig").alias("sig"), "uid", "n", "rest")


def _sizes_fit(percent: int):
    return (F.least("n", "other_n") * 100 >= F.greatest("n", "other_n") * percent)


def _needed(percent: int):
    """Overlap that a pair of these sizes needs."""
    return F.ceil((F.col("n") + F.col("other_n")) * percent / F.lit(100 + percent) - 1e-9)


def _apart():
    """In how many bits the sketches of a pair differ: no more than the sets differ in tokens."""
    return sum((F.bit_count(F.col(m).bitwiseXOR(F.col(f"other_{m}"))) for m in _MARKS), F.lit(0))


def _wide_apart():
    """As ``_apart`` for the wide sketches (0 without): the longer one is folded, its halves XORed."""
    def folded(name: str, other: str):
        half = (F.size(name) / 2).cast("int")
        halves = F.zip_with(F.slice(name, F.lit(1), half), F.slice(name, half + 1, half), lambda a, b: a.bitwiseXOR(b))
        return F.when(F.size(name) == 2 * F.size(other), halves).otherwise(F.col(name))

    both = F.zip_with(folded("wide", "other_wide"), folded("other_wide", "wide"), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    near = (F.size("wide") <= 2 * F.size("other_wide")) & (F.size("other_wide") <= 2 * F.size("wide"))
    return F.when(near, F.aggregate(both, F.lit(0), lambda a, b: a + b)).otherwise(F.lit(0))


def _may_link(percent: int):
    """Sizes and sketches allow the threshold."""
    most = F.col("n") + F.col("other_n") - 2 * _needed(percent)
    return _sizes_fit(percent) & (_apart() <= most) & (_wide_apart() <= most)


def _verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the ``uid, other`` pairs whose whole sets reach the threshold."""
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingler(width)
        for batch in batches:
            yield pd.DataFrame({"uid": batch["uid"], "set": [shingles(t).tobytes() for t in batch["text"]]})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for a, b in zip(batch["a"], batch["b"], strict=True):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = np.sort(np.concatenate([a, b]), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield batch.loc[keep, ["uid", "other"]]

    nodes = written(pairs.select("uid").unionByName(pairs.select(F.col("other").alias("uid"))).distinct(), "nodes")
    whole = written(_texts_of(docs, nodes).select("uid", "text").mapInPandas(sets, "uid long, set binary"), "sets")
    rows = (pairs.join(whole.select(F.col("uid").alias("other"), F.col("set").alias("b")), "other")
            .join(whole.select("uid", F.col("set").alias("a")), "uid"))
    out = written(rows.select("uid", "other", "a", "b").mapInPandas(compare, "uid long, other long"), "links")
    dropped(whole)
    return out


def components(links: DataFrame) -> DataFrame:
    """``uid, comp``: the smallest uid reachable, for rows that have a link.

    Each round takes the smallest label among the neighbours and then follows
    labels to their own label, so that distances shrink fast."""
    back = links.select(F.col("other").alias("uid"), F.col("uid").alias("other"))
    both = written(links.select("uid", "other").unionByName(back).distinct(), "both")
    labels = written(both.groupBy("uid").agg(F.least(F.col("uid"), F.min("other")).alias("comp")), "comp")
    while True:
        seen = (both.join(labels.select(F.col("uid").alias("other"), "comp"), "other")
                .groupBy("uid").agg(F.min("comp").alias("near")))
        step = written(labels.join(seen, "uid").select(
            "uid", F.least("comp", "near").alias("next"), F.col("comp").alias("was")), "step")
        jump = labels.select(F.col("uid").alias("next"), F.col("comp").alias("up"))
        new = written(step.join(jump, "next").select(
            "uid", F.least("next", "up").alias("comp"), (F.least("next", "up") != F.col("was")).alias("moved")), "comp")
        moved = new.where("moved").limit(1).count()
        dropped(step)
        dropped(labels)
        labels = new
        if not moved:
            dropped(both)
            return labels.select("uid", "comp")


def _between(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Those of ``pairs`` whose rows lie in different components, with ``comp, other_comp``."""
    both = pairs.join(comps, "uid", "left").withColumn("comp", F.coalesce("comp", "uid")).join(
        comps.select(F.col("uid").alias("other"), F.col("comp").alias("other_comp")), "other", "left")
    return both.withColumn("other_comp", F.coalesce("other_comp", "other")).where("comp != other_comp")


def linked(docs: DataFrame, *, width: int = WIDTH, percent: int = PERCENT,
           frequent_labels: int = FREQUENT_LABELS) -> DataFrame:
    """``uid, doc_id, n_shingles, component, component_id``: one row per document.

    ``component`` names the linked group, ``uid`` the row in reading order; ``component_id`` is the smallest doc_id
    reachable over links.  ``docs`` is a stored table: its rows are read more
    than once and must come alike."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn(
        "uid", F.monotonically_increasing_id())
    rows = written(_sets(docs, width, percent), "rows")
    # A class of equal sets goes by its first row.
    classes = written(rows.where("n > 0").groupBy("key").agg(
        F.min("uid").alias("uid"), F.min("doc_id").alias("low"), F.count("*").alias("copies")), "classes")
    marks = ["wide", *_MARKS]
    able = written(rows.where(F.size("front") > 0).select("uid", "n", "labels", "front", *marks)
                   .join(small_side(classes.select("uid", "copies"), classes.count()), "uid"), "able")
    bitmaps = spark.sparkContext.broadcast(_held_by_many(able, frequent_labels, min(SHARED_LABELS, frequent_labels)))

    # Near copies: every class against the one with most copies among those that share
    # a smallest token, which is likely the text that the others were made from.
    sizes = able.select("uid", "n", "copies", *marks, F.explode("labels").alias("label"))
    pivots = sizes.groupBy("label").agg(F.max(F.struct("copies", -F.col("uid"), "uid", "n", *marks)).alias("p"),
                                        F.count("*").alias("m")).where("m > 1").select(
        "label", F.col("p.uid").alias("other"), F.col("p.n").alias("other_n"),
        *(F.col(f"p.{m}").alias(f"other_{m}") for m in marks))
    stars = written(sizes.join(pivots, "label").where((F.col("uid") != F.col("other")) & _may_link(percent))
                    .select("uid", "other").distinct(), "stars")
    first = _verified(stars, docs, width, percent)
    start = components(first)

    # Then pairs of different components that share an entry of the index.
    index = written(_index(docs, able, bitmaps, width, percent).join(start, "uid", "left")
                    .withColumn("comp", F.coalesce("comp", "uid")), "index")
    # Of those with several components, entries with the same rows (told by two sums of their hashes) are one with a count.
    several = index.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
    shared = written(index.join(several.select("sig"), "sig", "left_semi"), "shared")
    sums = [F.xxhash64("uid"), F.xxhash64(F.lit(1), "uid")]
    per_comp = shared.groupBy("sig", "comp").agg(F.count("*").alias("m"), *(F.bit_xor(h).alias(f"h{i}") for i, h in enumerate(sums)))
    mixed = per_comp.groupBy("sig").agg(F.max(F.struct("m", "comp")).alias("top"), F.sum("m").alias("size"),
                                        F.bit_xor("h0").alias("h0"), F.bit_xor("h1").alias("h1"))
    mixed = mixed.groupBy("size", "h0", "h1").agg(
        F.min("sig").alias("sig"), F.count("*").alias("times"), F.max("top.comp").alias("major")).select("sig", "times", "major")
    entries = written(shared.join(mixed, "sig").join(able.select("uid", *marks), "uid"), "mixed")
    for used in (able, index, shared):
        dropped(used)
    minor = entries.where(F.col("comp") != F.col("major")).drop("major")
    others = entries.select("sig", *(F.col(c).alias(f"other_{c}") for c in ("uid", "n", "rest", "comp", *marks)),
                            (F.col("comp") == F.col("major")).alias("in_major"))
    met = minor.join(others, "sig").where((F.col("comp") != F.col("other_comp")) & _may_link(percent)
                                          & (F.col("in_major") | (F.col("uid") < F.col("other_uid"))))
    keys = ["uid", "other", "n", "other_n", "behind", "apart"]
    pairs = written(met.select(F.least("uid", "other_uid").alias("uid"), F.greatest("uid", "other_uid").alias("other"),
                               F.least("n", "other_n").alias("n"), F.greatest("n", "other_n").alias("other_n"),
                               F.greatest("rest", "other_rest").alias("behind"), _apart().alias("apart"), "times")
                    .groupBy(*keys).agg(F.sum("times").alias("shared"))
                    .where(F.col("shared") + F.col("behind") >= _needed(percent)).select("uid", "other", "apart"), "pairs")
    dropped(entries)

    # The nearest pair of each two components first, then what is still apart.
    nearest = _between(pairs, start).groupBy(F.least("comp", "other_comp"), F.greatest("comp", "other_comp")).agg(
        F.min(F.struct("apart", "uid", "other")).alias("p")).select("p.uid", "p.other")
    more = _verified(written(nearest, "nearest"), docs, width, percent)
    links, comps = first.unionByName(more), start
    if not more.isEmpty():
        comps = components(links)
    second = _verified(written(_between(pairs, comps).select("uid", "other"), "between"), docs, width, percent)
    if not second.isEmpty():
        comps = components(links.unionByName(second))

    lows = classes.join(comps, "uid", "left").withColumn("comp", F.coalesce("comp", "uid"))
    lows = lows.join(lows.groupBy("comp").agg(F.min("low").alias("component_id")), "comp").select(
        "key", "comp", "component_id")
    return (rows.select("uid", "doc_id", F.col("n").cast("long").alias("n_shingles"), "key").join(lows, "key", "left")
            .select("uid", "doc_id", "n_shingles", F.coalesce("comp", -1 - F.col("uid")).alias("component"),
                    F.coalesce("component_id", "doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` with the smallest id of each linked group (null last, then as read)."""
    rows = written(linked(docs, **how).select("uid", "doc_id", "component"), "components")
    first = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("f"))
    kept = first.select(F.col("f.uid").alias("uid"))
    gone = written(rows.select("uid").join(kept, "uid", "left_anti").withColumnRenamed("uid", "__uid"), "gone")
    return (docs.select("*", F.monotonically_increasing_id().alias("__uid"))
            .join(small_side(gone, gone.count()), "__uid", "left_anti").select(*docs.columns))
