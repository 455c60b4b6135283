"""Prediction by partial matching over bytes, pretrained on the corpus.

A trie of byte contexts up to ``ORDER`` bytes holds how often each symbol
(a byte, or the end of the text) follows.  A symbol is coded in the longest
context known; if it was never seen there, an escape (method C: as likely as
the number of different symbols seen) leads to the context one byte shorter,
where the symbols of the longer one are excluded.  Below the empty context all
symbols not seen are alike.  The log10 probabilities add up per document.

With fixed counts the excluded set is that of the context just left, so each
context stores the total and escape of the next shorter one after exclusion, and
whole batches of text are scored at once in numpy, one table lookup per symbol
and order.

Counting is sharded: each task sorts its packed grams and sends them, as lists, to
the shard of the last ``DEEP`` symbols of their context, where they are added up and
those of shorter contexts follow from them.  A gram and its suffixes down to order
``DEEP`` have one shard; shorter ones (valid UTF-8 has some millions at most, and a
text far fewer) are summed over the shards.  Every counted gram takes part in the
scores.  A trie of at most ``MAX_NODES`` grams is broadcast whole.  Of a larger one
the costs of the grams that texts ask for most often (``MAX_NODES`` at most) are
broadcast; the other grams of the texts, seen or not, are sent to their shards,
whose part of the trie gives their costs.

Base scores (word unigrams with add-one smoothing) need the count of every
word: words among the most frequent (``HOT_WORDS`` at most, broadcast) are summed
where the text is read; the others, none of them hot, are joined by shuffle.

Defined cases: a null or empty text is one end symbol; without training texts
every symbol is alike; repeated rows are scored (and learnt from) each; a null id
counts as the empty id in the split; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tablestats.llm.common import dropped, id_remainder, small_batches, written

ORDER = 6
BITS = 9  # of a symbol: a byte or END
END = 256
SYMBOLS = 257
MAX_NODES = 2_000_000
HOT_WORDS = 100_000
MODULUS, HELD_OUT = 7, 2
_CHUNK = 1 << 18  # symbols worked on at once
DEEP = 3  # symbols of a context that tell its shard
SHARD_BYTES, MAX_SHARDS = 4_000_000, 8191  # training text a shard
LOW = -1  # in place of a shard: orders below DEEP
#: Distinct grams or words that a task holds before it sends them on.
_HELD = 1_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased; no other letter changes."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def chunks(texts, order: int = ORDER) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``symbols, known, owner``: texts end to end, how many symbols of the same
    text precede each (at most ``order``), and its text's number.  A long text
    is cut; the ``order`` symbols before a cut are repeated with ``known`` -1."""
    symbols, known, owner, size = [], [], [], 0
    for i, text in enumerate(texts):
        s = np.concatenate([np.frombuffer(normal(text), np.uint8).astype(np.uint64), [np.uint64(END)]])
        for at in range(0, len(s), _CHUNK):
            back = min(order, at)
            part = s[at - back:at + _CHUNK]
            k = np.minimum(np.arange(at - back, at - back + len(part)), order)
            k[:back] = -1
            symbols.append(part)
            known.append(k)
            owner.append(np.full(len(part), i))
            size += len(part)
            if size >= _CHUNK:
                yield tuple(map(np.concatenate, (symbols, known, owner)))
                symbols, known, owner, size = [], [], [], 0
    if size:
        yield tuple(map(np.concatenate, (symbols, known, owner)))


def packed(symbols: np.ndarray, order: int) -> np.ndarray:
    """Each symbol with the ``order`` before it, oldest in the highest bits."""
    out = symbols.copy()
    for k in range(1, order + 1):
        out[k:] |= symbols[:-k] << np.uint64(BITS * k)
    return out


def cut(codes: np.ndarray, order: int) -> np.ndarray:
    """The grams' suffixes of ``order`` symbols before the last."""
    return codes & np.uint64((1 << BITS * (order + 1)) - 1)


def _added(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted codes and their summed counts."""
    if counts is None:
        codes = np.sort(codes)
        starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, int)
        return codes[starts], np.diff(np.append(starts, len(codes)))
    place = np.argsort(codes, kind="stable")
    codes, counts = codes[place], counts[place]
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, int)
    return codes[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def count_grams(texts, order: int = ORDER) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Counts of each symbol with its longest context (shorter ones follow from them)."""
    parts: dict[int, list] = {k: [] for k in range(order + 1)}
    for symbols, known, _ in chunks(texts, order):
        codes = packed(symbols, order)
        early = np.flatnonzero((known >= 0) & (known < order))
        for k in range(order + 1):
            at = known == order if k == order else early[known[early] == k]
            parts[k].append(_added(cut(codes[at], k)))
            if len(parts[k]) >= 16:
                parts[k] = [_added(*map(np.concatenate, zip(*parts[k])))]
    return {k: _added(*map(np.concatenate, zip(*v))) for k, v in parts.items() if v}


def with_shorter(grams: dict[int, tuple[np.ndarray, np.ndarray]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Counts for all orders: a gram counts in each of its suffixes, order by order."""
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for k in sorted(grams, reverse=True):
        codes, n = grams[k]
        if k + 1 in out:
            longer, m = out[k + 1]
            codes = np.concatenate([codes, longer & np.uint64((1 << BITS * (k + 1)) - 1)])
            n = np.concatenate([n, m])
        out[k] = _added(codes, n)
    return out


def _level(k: int, codes: np.ndarray, n: np.ndarray, low: dict | None) -> dict:
    """Costs of the grams and contexts of order ``k``; ``low``: those of the order below."""
    ctx = codes >> np.uint64(BITS)
    starts = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]]))
    total = np.add.reduceat(n, starts).astype(np.float64)
    kinds = np.diff(np.append(starts, len(codes))).astype(np.float64)
    group = np.repeat(np.arange(len(starts)), kinds.astype(np.int64))
    level = {"logp": np.log10(n / (total + kinds)[group]), "logn": np.log10(n),
             "escape": np.log10(kinds / (total + kinds)), "n": n, "total": total, "kinds": kinds,
             "codes": codes, "contexts": ctx[starts]}
    if k == 0:
        left = np.maximum(SYMBOLS - kinds, 1)
        level["below"], level["below_escape"] = np.log10(left), np.zeros(1)
    else:
        up = np.searchsorted(low["codes"], codes & np.uint64((1 << BITS * k) - 1))
        home = np.searchsorted(low["contexts"], ctx[starts] & np.uint64((1 << BITS * (k - 1)) - 1))
        t = low["total"][home] - np.add.reduceat(low["n"][up], starts)
        d = low["kinds"][home] - kinds
        den = np.maximum(t + d, 1)
        level["below"] = np.log10(den)
        level["below_escape"] = np.where(d > 0, np.log10(np.maximum(d, 1) / den), 0.0)
    return level


class Model:
    """The trie as arrays: per order sorted grams and contexts, found by hashing."""

    def __init__(self, grams: dict[int, tuple[np.ndarray, np.ndarray]], low: list[dict] | None = None):
        """``grams[k]``: sorted packed grams of order k and their counts (closed under suffixes).

        ``low``: the ``levels`` of the shortest orders, if ``grams`` is a shard that has only the others."""
        self.levels = list(low or [])
        for k in range(len(self.levels), max(grams, default=-1) + 1):
            codes, n = grams[k]
            if not len(codes):
                break
            level = _level(k, codes, n, self.levels[k - 1] if k else None)
            level["gram_table"], level["context_table"] = _hashed(codes), _hashed(level["contexts"])
            self.levels.append(level)

    def packed_small(self) -> Model:
        """Without what only further orders need, and in single precision: to be broadcast."""
        for level in self.levels:
            for name in ("n", "total", "kinds", "codes", "contexts"):
                del level[name]
            for name in ("logp", "logn", "escape", "below", "below_escape"):
                level[name] = level[name].astype(np.float32)
        return self

    def costs(self, symbols: np.ndarray, known: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol; 0 where ``known`` is -1."""
        at = np.flatnonzero(known >= 0)
        out = np.zeros(len(symbols))
        out[at] = self.of(packed(symbols, max(len(self.levels) - 1, 0))[at], known[at])
        return out

    def of(self, codes: np.ndarray, known: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's last symbol; ``known``: its symbols before that."""
        top = len(self.levels) - 1
        out = np.zeros(len(codes))
        if top < 0:
            out -= math.log10(SYMBOLS)
            return out
        left = np.arange(len(codes))
        state = np.full(len(left), -1)  # the context just left, by its place among those of order k + 1
        for k in range(top, -1, -1):
            level = self.levels[k]
            here = known[left] >= k
            wait, wait_state = left[~here], state[~here]
            at, state = left[here], state[here]
            code = cut(codes[at], k)
            found = _find(level["gram_table"], code)
            hit, free = found >= 0, state < 0
            first = hit & free
            out[at[first]] += level["logp"][found[first]]
            later = hit & ~free
            if later.any():
                out[at[later]] += level["logn"][found[later]] - self.levels[k + 1]["below"][state[later]]
            at, state, code = at[~hit], state[~hit], code[~hit]
            escaped = state >= 0
            if escaped.any():
                out[at[escaped]] += self.levels[k + 1]["below_escape"][state[escaped]]
            ctx = _find(level["context_table"], code >> np.uint64(BITS))
            fresh = ~escaped & (ctx >= 0)
            out[at[fresh]] += level["escape"][ctx[fresh]]
            left, state = np.concatenate([wait, at]), np.concatenate([wait_state, ctx])
        out[left] -= self.levels[0]["below"][0]
        return out

    def scores(self, texts: list) -> np.ndarray:
        total = np.zeros(len(texts))
        for symbols, known, owner in chunks(texts, max(len(self.levels) - 1, 0)):
            total += np.bincount(owner, weights=self.costs(symbols, known), minlength=len(texts))
        return total


class Often:
    """Costs of frequent grams of a larger trie, each coded in its own context."""

    def __init__(self, grams: dict[int, tuple[np.ndarray, np.ndarray]]):
        """``grams[k]``: packed grams of order k and the log10 probability of their last symbol."""
        self.order = max(grams)
        self.levels = [(_hashed(grams[k][0]), grams[k][1]) for k in range(self.order + 1)]

    def parts(self, texts: list) -> tuple[np.ndarray, tuple]:
        """Sums of the known costs, and ``owner, level, code, times`` of the texts' other grams."""
        total, rest = np.zeros(len(texts)), [[np.empty(0, kind)] for kind in (np.int64, np.int32, np.uint64, np.int32)]
        for symbols, known, owner in chunks(texts, self.order):
            codes = packed(symbols, self.order)
            for k, (table, costs) in enumerate(self.levels):
                at = np.flatnonzero(known == k)
                code, own = cut(codes[at], k), owner[at]
                found = _find(table, code)
                hit = found >= 0
                total += np.bincount(own[hit], weights=costs[found[hit]], minlength=len(texts))
                code, own = code[~hit], own[~hit]
                place = np.lexsort((code, own))
                code, own = code[place], own[place]
                new = np.ones(len(code), bool)
                new[1:] = (code[1:] != code[:-1]) | (own[1:] != own[:-1])
                starts = np.flatnonzero(new)
                for column, values in zip(rest, (own[starts], np.full(len(starts), k), code[starts],
                                                 np.diff(np.append(starts, len(code)))), strict=True):
                    column.append(values.astype(column[0].dtype))
        return total, tuple(map(np.concatenate, rest))


_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def _hashed(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Open-addressing table: keys, places, shift."""
    bits = max(4, int(len(codes) * 1.6).bit_length())
    keys, places = np.full(1 << bits, _EMPTY), np.full(1 << bits, -1, np.int32)
    todo = np.arange(len(codes), dtype=np.int64)
    slot = ((codes * _ODD) >> np.uint64(64 - bits)).astype(np.int64)
    while len(todo):
        free = places[slot] < 0
        keys[slot[free]], places[slot[free]] = codes[todo[free]], todo[free]  # the last writer stays
        lost = places[slot] != todo
        todo, slot = todo[lost], (slot[lost] + 1) & ((1 << bits) - 1)
    return keys, places, 64 - bits


def _find(table: tuple[np.ndarray, np.ndarray, int], codes: np.ndarray) -> np.ndarray:
    """The place of each code, -1 if unknown."""
    keys, places, shift = table
    slot = ((codes * _ODD) >> np.uint64(shift)).astype(np.int64)
    key = keys[slot]
    out = np.where(key == codes, places[slot], -1)
    todo = np.flatnonzero((key != codes) & (key != _EMPTY))
    while len(todo):
        slot[todo] = (slot[todo] + 1) & (len(keys) - 1)
        key = keys[slot[todo]]
        same = key == codes[todo]
        out[todo[same]] = places[slot[todo[same]]]
        todo = todo[~same & (key != _EMPTY)]
    return out


def least_count(histogram: list[tuple[int, int]], most: int) -> int:
    """Smallest count c such that at most ``most`` entries have a count of c or more.

    ``histogram``: (lower bound of a range of counts, entries in it)."""
    total = 0
    for low, n in sorted(histogram, reverse=True):
        total += n
        if total > most:
            return low + 1 if low < 64 else math.ceil(low * 1.1) + 1
    return 1


def _histogram(counts: DataFrame) -> list[tuple[int, int]]:
    """Entries by count: exact up to 63, then in ranges a tenth wide (some hundred rows)."""
    step = F.floor(F.log(F.col("n")) / math.log(1.1))
    low = F.when(F.col("n") < 64, F.col("n")).otherwise(F.greatest(F.lit(64), F.floor(F.pow(F.lit(1.1), step)))).cast("long")
    return [(r["low"], r["k"]) for r in counts.groupBy(low.alias("low")).agg(F.count("*").alias("k")).collect()]


def _shard(codes: np.ndarray, deep: int, shards: int) -> np.ndarray:
    """By the last ``deep`` symbols of the context: those of a gram's suffixes are the same down to order ``deep``."""
    key = (codes >> np.uint64(BITS)) & np.uint64((1 << BITS * deep) - 1)
    return (((key + np.uint64(1)) * _ODD) >> np.uint64(40)).astype(np.int64) % shards


def _by_shard(deep: int, shards: int, level: np.ndarray, codes: np.ndarray, **more: np.ndarray) -> dict:
    """A row for each shard met, with lists of its grams; ``LOW`` has those of an order below ``deep``."""
    shard = np.where(level < deep, LOW, _shard(codes, deep, shards)).astype(np.int32)
    place = np.argsort(shard, kind="stable")
    found, starts = np.unique(shard[place], return_index=True)
    offsets = pa.array(np.append(starts, len(place)).astype(np.int32))
    columns = {"levels": level, "codes": codes.view(np.int64), **more}
    return {"shard": pa.array(found)} | {c: pa.ListArray.from_arrays(offsets, pa.array(v[place])) for c, v in columns.items()}


def _flat(rows: pa.Table, name: str) -> np.ndarray:
    """The lists of a column end to end."""
    return pa.concat_arrays([c.flatten() for c in rows[name].chunks]).to_numpy()


_GRAMS = "shard int, level int, codes array<long>, n array<long>, own array<long>, den array<long>"


def _merged(order: int, deep: int):
    """A shard's grams of all orders: count ``n``, times met as the longest of a place ``own``, ``den`` of its context.

    Those of an order below ``deep`` are parts of a sum, all under ``LOW``."""
    def run(rows: pa.Table) -> pa.Table:
        level, codes, n = (_flat(rows, c) for c in ("levels", "codes", "n"))
        codes = codes.view(np.uint64)
        held = {k: _added(codes[at], n[at]) for k in range(order + 1) for at in [np.flatnonzero(level == k)]}
        shard, out = rows["shard"][0].as_py(), []
        for k, (code, count) in with_shorter(held).items():
            if not len(code):
                continue
            own = np.zeros(len(code), np.int64)
            own[np.searchsorted(code, held[k][0])] = held[k][1]
            ctx = code >> np.uint64(BITS)
            starts = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]]))
            kinds = np.diff(np.append(starts, len(code)))
            den = np.repeat(np.add.reduceat(count, starts) + kinds, kinds)
            whole = pa.array(np.array([0, len(code)], np.int32))
            out.append(pa.table({"shard": pa.array([shard if k >= deep else LOW], pa.int32()), "level": pa.array([k], pa.int32())} | {
                c: pa.ListArray.from_arrays(whole, pa.array(v))
                for c, v in (("codes", code.view(np.int64)), ("n", count), ("own", own), ("den", den))}))
        return pa.concat_tables(out)

    return run


def _arrays(rows, order: int) -> dict[int, tuple[np.ndarray, ...]]:
    """Per order the sorted codes of an Arrow table and its further columns."""
    levels, codes, *more = (rows[c].to_numpy() for c in rows.column_names)
    out = {}
    for k in range(order + 1):
        at = np.flatnonzero(levels == k)
        at = at[np.argsort(codes[at])]
        out[k] = codes[at].astype(np.uint64), *(m[at] for m in more)
    return out


def train(docs: DataFrame, *, order: int = ORDER, max_nodes: int = MAX_NODES) -> tuple[Model | Often, tuple | None]:
    """The model of ``docs.text``; at most ``max_nodes`` grams reach the driver, beside those of the shortest orders.

    A trie with more comes as its frequent grams, and the table of all grams by shard, the
    model of the shortest orders, their number and the number of shards."""
    spark, deep = docs.sparkSession, min(DEEP, order)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = 1 + min(MAX_SHARDS, size // SHARD_BYTES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}

        def rows():
            level = np.concatenate([np.full(len(codes), k, np.int32) for k, (codes, _) in held.items()])
            codes, n = (np.concatenate([h[i] for h in held.values()]) for i in (0, 1))
            return pa.RecordBatch.from_pydict(_by_shard(deep, shards, level, codes, n=n.astype(np.int64)))

        for batch in batches:
            for k, part in count_grams(batch["text"].to_pylist(), order).items():
                held[k] = _added(*map(np.concatenate, zip(held[k], part, strict=True))) if k in held else part
            if sum(len(codes) for codes, _ in held.values()) > _HELD:
                yield rows()
                held.clear()
        if held:
            yield rows()

    grams = docs.select("text").mapInArrow(count, "shard int, levels array<int>, codes array<long>, n array<long>")
    grams = written(grams.groupBy("shard").applyInArrow(_merged(order, deep), _GRAMS), "grams")
    each = grams.select("shard", "level", F.explode(F.arrays_zip("codes", "n", "own", "den")).alias("g")).select("shard", "level", "g.*")
    low = _arrays(each.where(F.col("shard") == LOW).groupBy("level", F.col("codes").alias("code"))
                  .agg(F.sum("n"), F.sum("own")).toArrow(), order)
    shortest = Model({k: low[k][:2] for k in range(deep)})
    held = grams.where(F.col("shard") != LOW).agg(F.coalesce(F.sum(F.size("codes")), F.lit(0))).first()[0]
    each = each.where(F.col("shard") != LOW)
    whole = held + sum(len(v[0]) for v in low.values()) <= max_nodes
    if whole:
        out = _arrays(each.select("level", "codes", "n").toArrow(), order)
        return Model({k: low[k][:2] if k < deep else out[k] for k in out}).packed_small(), None
    # The symbols of a text are looked up with their longest context, so grams that stand there often go to all tasks.
    own = [int(n) for k in range(deep) for n in low[k][2] if n]
    floor = least_count(_histogram(each.where("own > 0").select(F.col("own").alias("n"))) + list(Counter(own).items()), max_nodes)
    often = _arrays(each.where(F.col("own") >= floor).select("level", "codes", F.log10(F.col("n") / F.col("den"))).toArrow(), order)
    for k in range(min(deep, len(shortest.levels))):
        kept = low[k][2] >= floor
        often[k] = low[k][0][kept], shortest.levels[k]["logp"][kept]
    return Often(often), (grams.where(F.col("shard") != LOW).select("shard", "level", "codes", "n"), shortest, deep, shards, grams)


def _shard_costs(shortest, order: int):
    """Costs of the grams that texts ask of one shard, summed by text."""
    def run(asked: pa.Table, grams: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return pa.table({"uid": pa.array([], pa.int64()), "more": pa.array([], pa.float64())})
        held = {k: (np.empty(0, np.uint64), np.empty(0, np.int64)) for k in range(order + 1)}
        for i, k in enumerate(grams["level"].to_pylist()):
            held[k] = _flat(grams[i:i + 1], "codes").view(np.uint64), _flat(grams[i:i + 1], "n")
        model = Model(held, shortest.value.levels)
        sizes = np.concatenate([c.value_lengths().to_numpy() for c in asked["codes"].chunks])
        level, codes, times, place = (_flat(asked, c) for c in ("levels", "codes", "times", "places"))
        uid = np.repeat(asked["uid"].to_numpy(), sizes) + place
        costs = np.empty(len(codes))
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            distinct, back = np.unique(codes[at].view(np.uint64), return_inverse=True)
            costs[at] = model.of(distinct, np.full(len(distinct), k))[back]
        found, back = np.unique(uid, return_inverse=True)
        return pa.table({"uid": found, "more": np.bincount(back, weights=times * costs)})

    return run


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` over all texts (A-Z lower-cased; words have no ASCII white space)."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()

        def rows():
            return pd.DataFrame({"word": [w.decode("utf-8", "replace") for w in held], "n": list(held.values())})

        for batch in batches:
            for text in batch["text"]:
                held.update(normal(text).split())
                if len(held) > _HELD // 4:
                    yield rows()
                    held.clear()
        if held:
            yield rows()

    return docs.select("text").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def score(docs: DataFrame, *, order: int = ORDER, max_nodes: int = MAX_NODES, hot_words: int = HOT_WORDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per document."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"),
                       (id_remainder("doc_id", MODULUS) == HELD_OUT).alias("held_out"))
    learnt = docs.where("not held_out")
    trained, tables = train(learnt, order=order, max_nodes=max_nodes)
    model, whole = spark.sparkContext.broadcast(trained), tables is None
    grams, shortest, deep, shards, all_grams = tables or [None] * 5
    counts = written(word_counts(learnt), "words")
    ends = learnt.count()
    total, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, kinds = total + ends, kinds + (ends > 0)
    floor = least_count(_histogram(counts), hot_words)
    often = counts.where(F.col("n") >= floor).toArrow()
    hot = spark.sparkContext.broadcast(dict(zip(often["word"].to_pylist(), often["n"].to_pylist(), strict=True)))

    columns = ("uid long, doc_id long, held_out boolean, n_tokens long, near double, seen long, rare array<string>, score double, "
               "shard int, levels array<int>, codes array<long>, times array<int>, places array<int>")
    schema = to_arrow_schema(StructType.fromDDL(columns))

    def row_batch(**held) -> pa.RecordBatch:
        n = len(held["uid"])
        return pa.RecordBatch.from_arrays([
            pa.nulls(n, f.type) if f.name not in held else held[f.name].cast(f.type) if isinstance(held[f.name], pa.Array)
            else pa.array(held[f.name], f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {w.encode("utf-8"): math.log10(n + 1) for w, n in hot.value.items()}
        get = known.get
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch["text"].to_pylist()
            n_tokens, near, seen, rare = [], [], [], []
            for text in texts:
                found = normal(text).split()
                values = np.array([get(w, -1.0) for w in found], np.float64)
                have = values >= 0
                n_tokens.append(len(found) + 1)
                near.append(float(values[have].sum()))
                seen.append(int(have.sum()))
                rare.append([found[i].decode("utf-8", "replace") for i in np.flatnonzero(~have)])
            uid = batch["uid"].to_numpy()
            out = {"uid": uid, "doc_id": batch["doc_id"], "held_out": batch["held_out"],
                   "n_tokens": n_tokens, "near": near, "seen": seen, "rare": rare}
            if whole:
                yield row_batch(**out, score=model.value.scores(texts))
                continue
            sums, (owner, level, code, times) = model.value.parts(texts)
            yield row_batch(**out, score=sums)
            asked = _by_shard(deep, shards, level, code, times=times, places=(uid - uid[0])[owner].astype(np.int32))
            yield row_batch(**asked, uid=np.full(len(asked["shard"]), uid[0]))

    # A row with a shard holds what the texts from ``uid`` on ask of it.
    table = written(docs.withColumn("uid", F.monotonically_increasing_id()).mapInArrow(run, columns), "scored")
    rows = table.where("shard is null").select("uid", "doc_id", "held_out", "n_tokens", "near", "seen", "rare", "score")
    # A word that is not learnt adds log10(1) = 0, so only known words are joined.
    far = (rows.select("uid", F.explode("rare").alias("word"))
           .join(counts.where(F.col("n") < floor), "word")
           .groupBy("uid").agg(F.sum(F.log10(F.col("n") + 1)).alias("far"), F.count("*").alias("met")))
    log_end = math.log10(ends + 1)
    per_token = math.log10(total + kinds + 1)
    scored = rows.drop("rare").join(far, "uid", "left")
    if not whole:
        asked = table.where("shard is not null").select("uid", "shard", "levels", "codes", "times", "places")
        low = spark.sparkContext.broadcast(shortest)
        more = written(asked.groupBy("shard").cogroup(grams.groupBy("shard"))
                       .applyInArrow(_shard_costs(low, order), "uid long, more double")
                       .groupBy("uid").agg(F.sum("more").alias("more")), "more")
        dropped(all_grams)
        scored = scored.join(more, "uid", "left").withColumn("score", F.col("score") + F.coalesce("more", F.lit(0.0)))
    return scored.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("seen") + F.coalesce("met", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("near") + F.coalesce("far", F.lit(0.0)) + F.lit(log_end)
         - F.col("n_tokens") * F.lit(per_token)).alias("base_score"), "score")
