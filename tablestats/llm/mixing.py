"""Mixing sources to target weights by Sainte-Lague apportionment.

Each source's documents are laid on a line of tokens in seeded order, pass
after pass, and the line is cut into blocks of equal tokens.  Highest
quotients (``target / (2 * seats + 1)``) give every source an integer number of
blocks, shard by shard of the mix (the method is house monotone, so the quotas
of a shard are the difference of two cumulative allocations).  The blocks taken
are the first ones of the seeded line, so a document's taken words follow from
its position alone: no table of blocks is ever made.

Scale: one narrow row (id, source, size) per document is shuffled once by
(source, cell); a cell is a hash range of a source, so a source with a third of
all rows is spread over ``cells`` tasks.  Positions are cell offset + running
sum within the cell.  Only one total per source reaches the driver.

Defined cases: a null text has size 0 and takes nothing; a null source is a
source of its own, last in order; repeated rows count as often as they occur;
no documents gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablestats.llm.common import small_side, text_or_empty, written

MAX_SOURCES = 100_000
CAP = 3
BLOCK_TOKENS = 16
CELLS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def capped_targets(sizes: list[int], weights: list[float], cap: int = CAP) -> list[float]:
    """Shares of ``sum(sizes)`` by weight, each at most ``cap`` times its size.

    What a full source can't hold is shared again by weight among the others.
    """
    out, left, open_ = [0.0] * len(sizes), float(sum(sizes)), list(range(len(sizes)))
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > cap * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = float(cap * sizes[i])
        left -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def sainte_lague(targets: list[float], seats: int) -> list[int]:
    """``seats`` handed out one by one to the highest ``target / (2 * held + 1)``.

    Ties go to the earlier entry.  Starts from the rounded shares, which differ
    from the result by less than one seat an entry, and adds or takes back.
    """
    total = sum(targets)
    if seats <= 0 or total <= 0:
        return [0] * len(targets)
    held = [int(t * seats / total + 0.5) for t in targets]
    missing = seats - sum(held)
    sign = 1 if missing >= 0 else -1  # quotient of the next seat, or of the last one
    heap = [(-sign * t / (2 * h + sign), sign * i) for i, (t, h) in enumerate(zip(targets, held, strict=True))
            if sign > 0 or h]
    heapq.heapify(heap)
    for _ in range(abs(missing)):
        i = abs(heap[0][1])
        held[i] += sign
        if sign < 0 and not held[i]:
            heapq.heappop(heap)
        else:
            heapq.heapreplace(heap, (-sign * targets[i] / (2 * held[i] + sign), sign * i))
    return held


def shard_quotas(targets: list[float], seats: int, shards: int) -> list[list[int]]:
    """Integer block quotas, one list per shard, summing to ``sainte_lague``."""
    out, before = [], [0] * len(targets)
    for h in range(1, shards + 1):
        held = sainte_lague(targets, seats * h // shards)
        out.append([b - a for a, b in zip(before, held, strict=True)])
        before = held
    return out


def source_key(source: str = "source") -> Column:
    """Sorts by code point with null last, and joins null with null."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("~"))


def mix(docs: DataFrame, *, weights: tuple[float, ...] = (1, 2, 3), cap: int = CAP,
        block_tokens: int = BLOCK_TOKENS, shards: int = 8, cells: int = CELLS, seed: int = 17,
        max_sources: int = MAX_SOURCES) -> tuple[DataFrame, DataFrame]:
    """Rows of the mix and the block quotas.

    First: ``doc_id, size, source, uid, source_size, target, position, taken,
    passes, shard_words``, one row per document (``taken``: words; ``passes``: how many
    passes begin the document, for mixing whole documents; ``uid``: the row in
    reading order; ``shard_words``: the words taken by the quota of each shard of the
    mix, whose blocks follow each other on the source's line).  Second: ``source, shard, blocks``.  Sources
    weigh ``weights`` in turn, in order of code points.
    """
    spark = docs.sparkSession
    rows = written(docs.select(
        "doc_id", word_count().alias("size"), source_key().alias("source"),
        F.xxhash64(F.col("text").isNull(), F.col("text")).alias("row"), F.monotonically_increasing_id().alias("uid"),
        F.xxhash64(F.lit(seed), F.col("doc_id")).alias("draw"),
    ).withColumn("cell", F.pmod(F.xxhash64("draw", "row"), F.lit(cells)).cast("int")), "mix-rows")
    sums = rows.groupBy("source").agg(F.sum("size").alias("size"))
    totals = sorted((r["source"], r["size"]) for r in sums.limit(max_sources + 1).collect())
    if len(totals) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    sizes = [n for _, n in totals]
    targets = capped_targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], cap)
    seats = int(sum(targets) / block_tokens + 0.5)
    quotas = shard_quotas(targets, seats, shards)
    # Where each shard's blocks end on the source's line; the last end is all that is taken.
    ends = [[min(sum(q[i] for q in quotas[:h + 1]) * block_tokens, cap * n) for h in range(shards)]
            for i, n in enumerate(sizes)]
    plan = spark.createDataFrame(
        [(s, n, t, e[-1], e) for (s, n), t, e in zip(totals, targets, ends, strict=True)],
        "source string, source_size long, target double, reach long, ends array<long>")
    blocks = spark.createDataFrame(
        [(s, h, q[i]) for h, q in enumerate(quotas) for i, (s, _) in enumerate(totals)],
        "source string, shard int, blocks long")

    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("source", "cell").agg(F.sum("size").alias("n"))
               .select("source", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    inside = (Window.partitionBy("source", "cell").orderBy("draw", "doc_id", "row", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(offsets, ["source", "cell"])
              .join(F.broadcast(plan), "source")  # at most max_sources rows
              .withColumn("position", F.col("start") + F.col("inside")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("reach") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("reach") - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("position")))

    def words_before(end: Column) -> Column:
        """The document's words on the line before ``end``, pass after pass."""
        full = F.when(F.col("source_size") > 0, F.floor(end / F.col("source_size"))).otherwise(F.lit(0))
        here = end - full * F.col("source_size") - F.col("position")
        return (full * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), here))).cast("long")

    by_shard = F.transform("ends", lambda e, h: words_before(e) - F.when(
        h > 0, words_before(F.get("ends", h - 1))).otherwise(F.lit(0)))
    return placed.select(
        "doc_id", "size", F.when(F.col("source") != "~", F.substring("source", 2, 2**31 - 1)).alias("source"),
        "uid", "source_size", "target", "position",
        (whole * F.col("size") + part).cast("long").alias("taken"),
        (whole + (F.col("position") < rest).cast("long")).cast("int").alias("passes"),
        by_shard.alias("shard_words"),
    ), blocks


def mixed(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with every document as often as the mix begins it: whole documents.

    ``docs`` is a stored table: its rows are read twice and must come alike."""
    rows, _ = mix(docs, **how)
    taken = written(rows.where("passes > 0").select(F.col("uid").alias("__uid"), F.col("passes").alias("__passes")), "taken")
    numbered = docs.select("*", F.monotonically_increasing_id().alias("__uid"))
    return (numbered.join(small_side(taken, taken.count()), "__uid")
            .select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("__passes"))).alias("__pass")).drop("__pass"))
