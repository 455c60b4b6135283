"""Exact substring removal with suffix arrays over shards.

A byte goes if a string of ``SPAN`` bytes that covers it also starts earlier (in
a document before, or further left in the same one).

Shards are made by content, so that equal strings meet: of all grams of ``GRAM``
bytes in a window of ``SPAN`` bytes the smallest hash is the window's anchor,
a function of the window alone.  Windows in a row with one anchor form a run, and
its bytes are its context.  A window has at least half of its other bytes on one
side of its anchor, so windows that repeat share the anchor with that flank.  Flanked
anchors (two a run) are counted; runs of which none occurs twice in the corpus hold
no repeat (nor do they repeat within themselves unless the gram occurs twice, which
is told apart) and send nothing on.

Equal contexts of one anchor are a class: all but its first run go whole.  The
first runs of anchors with several classes are compared in shards of bounded
size, some anchors at a time: the suffix array of their contexts is sorted by the
first 8 bytes and then refined by doubling, ever only the groups still unsorted
(Larsson-Sadakane); neighbours are compared for their common prefixes, and suffixes
that share ``SPAN`` bytes are one group, of which the earliest start stays.  An
anchor with more classes or bytes than a shard holds is split over several; the
earliest windows of each shard are then merged: sorted by digest in a shuffle, each shard's window is looked up by
the digest and goes if another shard has an earlier one.

Scale: per run two hashes are shuffled (with partial sums); those that repeat
are marked in a bitmap of fixed size (``BITMAP_BITS``; chance hits only send a few
contexts more); contexts move only for repeats.  Neither a text nor a shard is
ever sent to the driver.  Digests are 64-bit prefix polynomials, and a class is
told by two of them.

Defined cases: a null text is empty; texts shorter than ``SPAN`` keep all; rows of
one id are ordered as read, null ids last; no documents gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestats.llm.common import BROADCAST_ROWS, small_batches, written

SPAN = 100
GRAM = 32
BITMAP_BITS = 27
SHARD_CLASSES = 4000  # first runs of one anchor that are sorted in one shard
SHARD_BYTES = 2_000_000
#: Bytes of contexts in one suffix array (more only for a single anchor, a shard's bytes at most).
_PIECE_BYTES = 1 << 18
_PAIRS = 1 << 16
_BITMAP = 1 << 15
_BASE = 0x9E3779B97F4A7C15
_ODD = np.uint64(_BASE)
_INVERSE = np.uint64(pow(_BASE, -1, 2**64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


class Digests:
    """Digest of any stretch of a text from prefix sums of byte values times powers."""

    _power = _back = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        if len(data) >= len(Digests._power):
            n = max(1 << 16, 2 * len(data)) + 1
            for name, base in (("_power", _ODD), ("_back", _INVERSE)):
                steps = np.full(n, base)
                steps[0] = 1
                setattr(Digests, name, np.multiply.accumulate(steps))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(_BYTE[data] * Digests._power[:len(data)])])

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return _mix((self.sums[hi] - self.sums[lo]) * Digests._back[lo] + (hi - lo).astype(np.uint64))


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    w = 1
    while w * 2 <= width:
        x, w = pick(x[:-w], x[w:]), w * 2
    return x if w == width else pick(x[:len(x) - (width - w)], x[width - w:])


def _reach(span: int, gram: int) -> int:
    """Every window of ``span`` bytes has as many beside its anchor, on the left or on the right."""
    return (span - gram + 1) // 2


def _slots(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def runs(data: np.ndarray, span: int = SPAN, gram: int = GRAM):
    """``anchor, lo, hi, again, digests, flanks`` of each run of windows with one anchor.

    ``again``: the anchor's gram occurs more than once in the context.  ``flanks``: number of
    the run and digest of the gram with ``_reach`` bytes to its left, and to its right,
    for each place where that lies in the context."""
    n, width = len(data), span - gram + 1
    if n < span:
        empty = np.empty(0, np.int64)
        return np.empty(0, np.uint64), empty, empty, np.empty(0, bool), None, (empty, np.empty(0, np.uint64))
    digests = Digests(data)
    at = np.arange(n - gram + 1)
    hashes = digests(at, at + gram)
    least = _sliding(hashes, width, np.minimum)  # one per window of span bytes
    lo = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    end = np.append(lo[1:], len(least))
    hi = end - 1 + span
    anchor = least[lo]
    # Grams that are the anchor of some window; then those in a context that equal its anchor.
    pad = np.zeros(width - 1, np.uint64)
    chosen = np.flatnonzero(_sliding(np.concatenate([pad, least, pad]), width, np.maximum) == hashes)
    a, b = np.searchsorted(chosen, lo), np.searchsorted(chosen, hi - gram, side="right")
    size = b - a
    place = np.repeat(a - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    equal = hashes[chosen[place]] == np.repeat(anchor, size)
    count = np.add.reduceat(equal.astype(np.int64), np.concatenate([[0], np.cumsum(size)[:-1]]))
    run, p, reach = np.repeat(np.arange(len(lo)), count), chosen[place[equal]], _reach(span, gram)
    left, right = p - reach >= lo[run], p + gram + reach <= hi[run]
    flanks = np.concatenate([digests(p[left] - reach, p[left] + gram), digests(p[right], p[right] + gram + reach)])
    return anchor, lo, hi, count > 1, digests, (np.concatenate([run[left], run[right]]), flanks)


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by at least their first ``depth`` bytes, and each one's rank.

    Starts from 8 packed bytes and doubles; a round sorts the members of groups
    that are still equal by the rank of what follows."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    packed = np.zeros(n, np.uint64)
    for j in range(8):
        packed = (packed << np.uint64(8)) | padded[j:j + n]
    order = np.argsort(packed, kind="stable")
    sorted_keys = packed[order]
    rank = np.empty(n, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    h = 8
    while h < depth:
        size = np.bincount(rank, minlength=n)
        where = np.flatnonzero(size[rank[order]] > 1)  # places of unsorted groups
        if not len(where):
            break
        some = order[where]
        follow = np.full(len(some), -1, np.int64)
        inside = some + h < n
        follow[inside] = rank[some[inside] + h]
        key = (rank[some].astype(np.uint64) << np.uint64(32)) | (follow + 1).astype(np.uint64)
        place = np.argsort(key, kind="stable")
        some, key = some[place], key[place]
        order[where] = some
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first = np.maximum.accumulate(np.where(new, np.arange(len(some)), 0))
        rank = rank.copy()
        rank[some] = where[first]
        h *= 2
    return order, rank


def common_prefixes(data: bytes, order: np.ndarray, most: int) -> np.ndarray:
    """Shared prefix of each suffix with the one before it in order, up to ``most``: eight bytes
    at a time, and of a bounded number of neighbours at once."""
    n = len(order)
    words = np.ndarray(n + most, "<u8", data + bytes(most + 8), strides=(1,))  # those at every byte
    out = np.zeros(n, np.int64)
    for at in range(1, n, _PAIRS):
        a, b = order[at - 1:min(at + _PAIRS, n) - 1], order[at:at + _PAIRS]
        size = np.minimum(most, n - np.maximum(a, b))
        left = np.arange(len(b))
        for depth in range(0, most, 8):
            x = words[a[left] + depth] ^ words[b[left] + depth]
            differ = x != 0
            low, gone = x[differ], left[differ]
            byte = np.log2((low & (~low + np.uint64(1))).astype(np.float64)).astype(np.int64) // 8
            size[gone] = np.minimum(size[gone], depth + byte)
            left = left[~differ]
        out[at:at + _PAIRS] = size
    return out


def window_groups(contexts: list[bytes], span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``context, offset, group`` of every whole window; equal windows share a group."""
    data = b"".join(contexts)
    sizes = np.array([len(c) for c in contexts], np.int64)
    order, _ = suffix_array(np.frombuffer(data, np.uint8), span)
    shared = common_prefixes(data, order, span)
    group_of = np.empty(len(data), np.int64)
    group_of[order] = np.cumsum(shared < span)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    windows = sizes - span + 1
    context = np.repeat(np.arange(len(contexts)), windows)
    offset = np.arange(windows.sum()) - np.repeat(np.concatenate([[0], np.cumsum(windows)[:-1]]), windows)
    return context, offset, group_of[begin[context] + offset]


def _merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of stretches: sorted, touching ones joined."""
    place = np.argsort(lo, kind="stable")
    lo, reach = lo[place], np.maximum.accumulate(hi[place])
    new = np.concatenate([[True], lo[1:] > reach[:-1]]) if len(lo) else np.empty(0, bool)
    at = np.flatnonzero(new)
    return lo[at], reach[np.append(at[1:], len(lo)) - 1] if len(lo) else hi


def _repeated_flanks(docs: DataFrame, span: int, gram: int) -> np.ndarray:
    """Bitmap of the flanked anchors that the corpus holds twice or more."""
    def flanks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [runs(_bytes(t), span, gram)[-1][1] for t in batch["text"]]
            yield pd.DataFrame({"flank": np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64)})

    rows = (docs.select("text").mapInPandas(flanks, "flank long").groupBy("flank").agg(F.count("*").alias("n"))
            .where("n > 1").select(F.shiftrightunsigned("flank", 64 - BITMAP_BITS).cast("int").alias("slot"))
            .groupBy(F.floor(F.col("slot") / _BITMAP).alias("b"))
            .agg(F.bitmap_construct_agg(F.col("slot") % _BITMAP).alias("bits")).collect())  # 16 MB at most
    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for r in rows:
        at = r["b"] * _BITMAP // 8
        out[at:at + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return out


def _bounded(df: DataFrame, array: str) -> DataFrame:
    """Broadcast within a counted bound of rows and array elements; else as it is."""
    rows, held = df.agg(F.count("*"), F.coalesce(F.sum(F.size(array)), F.lit(0))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and held <= 2 * BROADCAST_ROWS else df


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def _found_runs(docs: DataFrame, bitmap, span: int, gram: int) -> DataFrame:
    """The runs of which a flank repeats (by the bitmap), or the anchor within the context."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for i, text in enumerate(batch["text"]):
                anchor, lo, hi, again, digests, (run, flanks) = runs(_bytes(text), span, gram)
                if not len(anchor):
                    continue
                slot = _slots(flanks)
                met = (bitmap.value[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
                use = np.flatnonzero(again | (np.bincount(run[met], minlength=len(anchor)) > 0))
                if len(use):
                    lo, hi = lo[use], hi[use]
                    parts.append((anchor[use], digests(lo, hi), again[use], np.full(len(use), i), lo, hi))
            if parts:
                anchor, digest, again, i, lo, hi = map(np.concatenate, zip(*parts))
                yield pd.DataFrame({
                    "anchor": anchor.view(np.int64), "digest": digest.view(np.int64), "again": again,
                    "doc": batch["doc"].to_numpy()[i], "uid": batch["uid"].to_numpy()[i],
                    "lo": lo.astype(np.int32), "hi": hi.astype(np.int32)})

    return docs.select("doc", "uid", "text").mapInPandas(
        emit, "anchor long, digest long, again boolean, doc long, uid long, lo int, hi int")


def _contexts(rows: DataFrame) -> DataFrame:
    """One row per wanted stretch, with its bytes."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, uid, text, at in zip(batch["doc"], batch["uid"], batch["text"], batch["at"], strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                out += [(r["shard"], r["split"], r["anchor"], doc, uid, r["lo"], raw[r["lo"]:r["hi"]]) for r in at]
            yield pd.DataFrame(out, columns=["shard", "split", "anchor", "doc", "uid", "lo", "context"])

    return rows.select("doc", "uid", "text", "at").mapInPandas(
        cut, "shard long, split boolean, anchor long, doc long, uid long, lo int, context binary")


_SHARD_OUT = "kind int, uid long, lo int, hi int, anchor long, digest long, doc long"


def _pieces(anchors: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the contexts of whole anchors, about ``_PIECE_BYTES`` at a time, in their order."""
    place = np.argsort(anchors, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], anchors[place[1:]] != anchors[place[:-1]]]))
    bytes_ = np.add.reduceat(sizes[place], starts)
    cuts, held = [0], 0
    for at, size in zip(starts.tolist(), bytes_.tolist(), strict=True):
        if held and held + size > _PIECE_BYTES:
            cuts.append(at)
            held = 0
        held += size
    for a, b in zip(cuts, [*cuts[1:], len(place)], strict=True):
        yield np.sort(place[a:b])


def _sort_shard(span: int):
    """One shard: spans to remove, and for a split anchor the earliest of each window.

    Equal windows have one anchor, so the anchors of a shard are worked through in pieces."""
    def piece(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        contexts = pdf["context"].tolist()
        context, offset, group = window_groups(contexts, span)
        # Rows are in document order: within one document starts decide.
        lo, uid, doc_id = (pdf[c].to_numpy(np.int64) for c in ("lo", "uid", "doc"))
        start = lo[context] + offset
        doc = np.concatenate([[0], np.cumsum(uid[1:] != uid[:-1])])[context]
        place = np.lexsort((start, doc, group))
        g, d, s = group[place], doc[place], start[place]
        same = np.concatenate([[False], g[1:] == g[:-1]])
        # The same window can lie in two contexts of one document: it is one start.
        lead = np.maximum.accumulate(np.where(~same, np.arange(len(place)), 0))
        first = np.empty(len(place), bool)
        first[place] = (d == d[lead]) & (s == s[lead])
        late = np.flatnonzero(~first)
        late = late[np.lexsort((start[late], doc[late]))]
        d, s = doc[late], start[late]
        new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (s[1:] > s[:-1] + span)])[:len(late)])
        last = np.append(new[1:], len(late))[:len(new)] - 1
        yield pd.DataFrame({"kind": 0, "uid": uid[context[late[new]]], "lo": s[new], "hi": s[last] + span,
                            "anchor": 0, "digest": 0, "doc": 0})
        if pdf["split"].iloc[0]:
            keep = np.flatnonzero(first)
            data = np.frombuffer(b"".join(contexts), np.uint8)
            begin = np.concatenate([[0], np.cumsum([len(c) for c in contexts])[:-1]])
            at = begin[context[keep]] + offset[keep]
            yield pd.DataFrame({
                "kind": 1, "uid": uid[context[keep]], "lo": start[keep], "hi": start[keep] + span,
                "anchor": pdf["anchor"].to_numpy()[context[keep]], "digest": Digests(data)(at, at + span).view(np.int64),
                "doc": doc_id[context[keep]]})

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc", "uid", "lo"], kind="stable").reset_index(drop=True)
        sizes = pdf["context"].str.len().to_numpy(np.int64)
        out = [part for at in _pieces(pdf["anchor"].to_numpy(), sizes) for part in piece(pdf.iloc[at])]
        return pd.concat(out).astype({"lo": np.int32, "hi": np.int32, "kind": np.int32})

    return run


def repeats(docs: DataFrame, *, span: int = SPAN, gram: int = GRAM, shard_classes: int = SHARD_CLASSES,
            shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``uid, spans``: stretches to remove per row of ``docs`` (which has ``uid``)."""
    spark = docs.sparkSession
    docs = docs.withColumn("doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)))
    bitmap = spark.sparkContext.broadcast(_repeated_flanks(docs, span, gram))
    found = written(_found_runs(docs, bitmap, span, gram), "runs")
    place = F.struct("doc", "uid", "lo", "hi")
    classes = written(found.groupBy("anchor", "digest").agg(F.min(place).alias("first"), F.bool_or("again").alias("again"))
                      .select("anchor", "digest", "again", "first.*"), "classes")
    firsts = classes.select("anchor", "digest", F.col("uid").alias("first_uid"), F.col("lo").alias("first_lo"))
    whole = (found.select("anchor", "digest", "uid", "lo", "hi").join(firsts, ["anchor", "digest"])
             .where((F.col("uid") != F.col("first_uid")) | (F.col("lo") != F.col("first_lo"))).select("uid", "lo", "hi"))
    several = (classes.groupBy("anchor").agg(F.count("*").alias("n"), F.sum(F.col("hi") - F.col("lo")).alias("size"),
                                             F.bool_or("again").alias("some"))
               .where("n > 1 or some").select("anchor", "n", "size"))
    rows = written(classes.join(several, "anchor").select("anchor", "digest", "doc", "uid", "lo", "hi", "n", "size"), "firsts")
    total = rows.agg(F.coalesce(F.sum(F.col("hi") - F.col("lo")), F.lit(0))).first()[0]
    shards = max(1, total // shard_bytes)
    parts = F.least("n", F.greatest(F.ceil(F.col("n") / shard_classes), F.ceil(F.col("size") / shard_bytes)))
    split = parts > 1
    rows = rows.withColumns({
        "split": split,
        "shard": F.when(split, F.xxhash64("anchor", F.pmod(F.xxhash64("digest"), parts)))
                  .otherwise(F.pmod(F.xxhash64("anchor"), F.lit(shards)))})
    wanted = written(rows.groupBy("uid").agg(F.collect_list(F.struct("lo", "hi", "anchor", "shard", "split")).alias("at")),
                     "wanted")
    texts = docs.select("doc", "uid", "text").join(_bounded(wanted, "at"), "uid")
    sorted_ = written(_contexts(texts).groupBy("shard", "split").applyInPandas(_sort_shard(span), _SHARD_OUT), "shards")
    windows = sorted_.where("kind = 1")
    place = F.struct("doc", "uid", "lo")
    least = windows.groupBy("anchor", "digest").agg(F.min(place).alias("least"))
    later = (windows.join(least, ["anchor", "digest"])
             .where((F.col("uid") != F.col("least.uid")) | (F.col("lo") != F.col("least.lo"))).select("uid", "lo", "hi"))

    def union(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans = []
            for lo, hi in zip(batch["lo"], batch["hi"], strict=True):
                a, b = _merged(np.asarray(lo, np.int64), np.asarray(hi, np.int64))
                spans.append(np.stack([a, b], 1).ravel().astype(np.int32))
            yield pd.DataFrame({"uid": batch["uid"], "spans": spans})

    gone = whole.unionByName(sorted_.where("kind = 0").select("uid", "lo", "hi")).unionByName(later)
    pairs = F.collect_list(F.struct("lo", "hi")).alias("at")  # at most the bytes of one text
    return written(gone.groupBy("uid").agg(pairs).select("uid", F.col("at.lo").alias("lo"), F.col("at.hi").alias("hi"))
                   .mapInPandas(union, "uid long, spans array<int>"), "spans")


def deduplicated(docs: DataFrame, **how) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn(
        "uid", F.monotonically_increasing_id())
    spans = _bounded(repeats(docs, **how), "spans")

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, at in zip(batch["doc_id"], batch["text"], batch["spans"], strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                at = [] if at is None else list(at)
                kept = hashlib.sha256()
                last = gone = 0
                for a, b in zip(at[::2], at[1::2], strict=True):
                    kept.update(raw[last:a])
                    gone, last = gone + b - a, b
                kept.update(raw[last:])
                out.append((None if pd.isna(doc_id) else int(doc_id), len(raw), gone, len(at) // 2, kept.hexdigest()))
            frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
            yield frame.astype({"doc_id": "Int64"})

    return docs.join(spans, "uid", "left").select("doc_id", "text", "spans").mapInPandas(
        keep, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
