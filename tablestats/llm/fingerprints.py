"""I-Match fingerprints: hashes of a document's terms from randomised lexicons.

The lexicon keeps terms within a band of inverse document frequency: in at
least ``MIN_DOCS`` documents and in at most ``MAX_SHARE`` of all.  A document's
distinct lexicon terms, sorted, give its first hash.  The other hashes are of
its terms in randomised subsets of the lexicon: ``SUBSETS`` subsets at each of
the rates in ``RATES``, so that short and long documents alike have subsets in
which they keep a few terms.  Likeness of two fingerprints: 1 if the first hashes
agree, else the share of agreeing subset hashes among those where either
document has a term.

Document frequency is counted per hash slot of ``SLOTS``, over all documents,
and the lexicon is one bit per slot: a table of fixed size (2 MB) that is
broadcast however large the corpus is.  Terms that share a slot share its band.

Scale: one pass counts slots (partial sums per task), one shuffle orders the
texts by id, and each sorted partition is read as a stream: fingerprint and
edited fingerprint of a document need only its neighbour.  The first and last
document of each partition are written beside the rows and joined in a small
second step.

Defined cases: a null text is empty; a text without lexicon terms hashes all its
terms, one without terms hashes the text itself; rows of one id are ordered by
text hash; a single document is its own neighbour; no documents gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestats.llm.common import same_row, small_batches, written

SLOT_BITS = 24
RATES = (2, 4, 6, 8, 10)  # bits: a subset keeps 1 in 2**bits terms
SUBSETS = 24
MIN_DOCS = 2
MAX_SHARE = 0.05
_TERM = re.compile(r"[^\W_]+")
_BITMAP_BITS = 1 << 15  # bits in one value of Spark's bitmap functions
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Hasher:
    """64-bit term hashes, remembered up to ``memory`` terms."""

    def __init__(self, memory: int = 100_000):
        self.seen, self.memory = {}, memory

    def __call__(self, text: str) -> np.ndarray:
        """Sorted distinct hashes of the terms of ``text``."""
        found, seen = set(_TERM.findall(text.lower())), self.seen
        if len(seen) > self.memory:
            seen.clear()
        for t in found.difference(seen):
            seen[t] = xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass"))
        out = np.fromiter(map(seen.__getitem__, found), np.uint64, len(found))
        out.sort()
        return out


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


_SEEDS = _mix(np.arange(1, SUBSETS + 1, dtype=np.uint64) * _ODD)


def fingerprint(text: str, hashes: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
    """First hash, then 16 bits per subset (0: no term), as uint16 values."""
    slots = _slots(hashes)
    kept = hashes[(lexicon[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1]
    if not len(kept):
        kept = hashes
    if not len(kept):
        kept = np.array([xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))], np.uint64)
    first = np.frombuffer(hashlib.blake2b(kept.tobytes(), digest_size=8).digest(), np.uint16)
    draws = _mix(kept[None, :] ^ _SEEDS[:, None]).ravel()
    at = np.flatnonzero(draws < np.uint64(1 << (64 - RATES[0])))
    draws, subset = draws[at], at // len(kept)
    sums, members = np.zeros((len(RATES), SUBSETS), np.uint64), np.zeros((len(RATES), SUBSETS), np.int64)
    for i, bits in enumerate(RATES):  # each rate's members are among those of the rate before
        if i:
            at = np.flatnonzero(draws < np.uint64(1 << (64 - bits)))
            draws, subset = draws[at], subset[at]
        members[i] = np.bincount(subset, minlength=SUBSETS)
        some = np.flatnonzero(members[i])
        if not len(some):
            break
        starts = np.cumsum(members[i]) - members[i]
        sums[i, some] = np.add.reduceat(draws, starts[some])
    marks = np.where(members > 0, (_mix(sums * _ODD) & np.uint64(0xFFFF)) | np.uint64(1), np.uint64(0))
    return np.concatenate([first, marks.astype(np.uint16).ravel()])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if (a[:4] == b[:4]).all():
        return 1.0
    a, b = a[4:], b[4:]
    either = (a | b) > 0
    n = int(either.sum())
    return float((a == b)[either].sum() / n) if n else 0.0


def lexicon(docs: DataFrame, *, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> np.ndarray:
    """One bit per slot: is its document frequency within the band?"""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, terms = np.zeros(1 << SLOT_BITS, np.int32), Hasher()
        for batch in batches:
            for text in batch["text"]:
                slots = _slots(terms(text or ""))  # in order, as the hashes are
                counts[slots[np.diff(slots, prepend=-1) > 0]] += 1
        slots = np.flatnonzero(counts)
        for i in range(0, len(slots), 1 << 16):
            part = slots[i:i + (1 << 16)]
            yield pd.DataFrame({"slot": part.astype(np.int32), "n": counts[part]})

    n = docs.count()
    band = (docs.select("text").mapInPandas(count, "slot int, n int").groupBy("slot").agg(F.sum("n").alias("n"))
            .where(F.col("n").between(min_docs, max(min_docs, int(max_share * n)))))
    rows = band.groupBy(F.floor(F.col("slot") / _BITMAP_BITS).alias("b")).agg(
        F.bitmap_construct_agg(F.col("slot") % _BITMAP_BITS).alias("bits")).collect()  # 2 MB in all
    out = np.zeros(1 << (SLOT_BITS - 3), np.uint8)
    for r in rows:
        at = r["b"] * _BITMAP_BITS // 8
        out[at:at + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return out


_OUT = ("doc_id long, row long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
        "near_edited double, near_next double, part int, text string")


class _Editor:
    def __init__(self, lexicon_bits: np.ndarray):
        self.terms, self.bits = Hasher(), lexicon_bits

    def prepared(self, doc_id, row, text) -> tuple:
        text = text or ""
        return doc_id, row, text, fingerprint(text, self.terms(text), self.bits)

    def row(self, own: tuple, nxt: tuple) -> tuple:
        doc_id, row, text, print_ = own
        n = len(text)
        edited = text[:n - n // 2] + nxt[2][:n // 2]
        other = fingerprint(edited, self.terms(edited), self.bits)
        sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        return (doc_id, row, n, sha, print_.tobytes(), other.tobytes(), likeness(print_, other),
                likeness(print_, nxt[3]), None, None)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in _OUT.split(", ")])
    return frame.astype({"doc_id": "Int64", "row": "Int64", "n_chars": "Int64", "part": "Int32",
                         "near_edited": "Float64", "near_next": "Float64"})


def fingerprints(docs: DataFrame, *, partitions: int | None = None, **band) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    bits = spark.sparkContext.broadcast(lexicon(docs, **band))

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        editor, part, last = _Editor(bits.value), TaskContext.get().partitionId(), None
        for batch in batches:
            out = []
            for doc_id, row, text in zip(batch["doc_id"], batch["row"], batch["text"], strict=True):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                own = editor.prepared(doc_id, row, text)
                if last is None:  # kept as text for the partition before
                    out.append((doc_id, row, 0, "first", None, None, None, None, part, own[2]))
                else:
                    out.append(editor.row(last, own))
                last = own
            yield _frame(out)
        if last is not None:
            yield _frame([(last[0], last[1], 0, "last", None, None, None, None, part, last[2])])

    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.withColumn("row", same_row())
               .repartitionByRange(n, F.desc_nulls_last("doc_id"), F.desc("row"))
               .sortWithinPartitions(F.desc_nulls_last("doc_id"), F.desc("row")))
    rows = written(ordered.mapInPandas(stream, _OUT), "prints")
    parts = sorted(r["part"] for r in rows.where("part is not null").select("part").distinct().collect())
    follows = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    firsts = rows.where("part is not null and edited_sha256 = 'first'").select(
        F.col("part").alias("next"), F.col("doc_id").alias("next_id"), F.col("row").alias("next_row"),
        F.col("text").alias("next_text"))
    lasts = rows.where("part is not null and edited_sha256 = 'last'").select("part", "doc_id", "row", "text")

    def edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        editor = _Editor(bits.value)
        for batch in batches:
            yield _frame([editor.row(editor.prepared(None if pd.isna(r.doc_id) else int(r.doc_id), r.row, r.text),
                                     editor.prepared(None, r.next_row, r.next_text)) for r in batch.itertuples()])

    ends = lasts.join(follows, "part").join(firsts, "next").mapInPandas(edges, _OUT)
    return rows.where("part is null").unionByName(ends).select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")
