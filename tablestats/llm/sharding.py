"""Sharding by balanced label propagation.

Documents that share a link key pull each other towards one shard.  A document
may have several keys (``links``); ``link`` is its unit (here: equal texts),
whose documents end on one shard if quotas allow.  Labels start from a hash.

Rounds.  The table of edges (row, key) is joined with the labels, and it is
counted per key how its documents lie on the shards.  These counts are joined
back to the edges and summed per row: the shards of its neighbours and, once,
its own, so that two neighbours don't swap for ever.  Every row wants the shard
with most of them (ties: by a hash of its keys, alike for all rows of a key).
How many rows want to go from shard to shard is counted, and shares of these
moves are admitted that keep every shard within its quota; rows of one key are
admitted together.  The rounds end when nothing moves, or after ``rounds``.
Pairs of neighbours on different shards (cut edges) are counted in each round.

Balancing.  Units with at least 1 / ``HEAVY`` of the rows (so at most ``HEAVY``
units) are placed first, the largest first: whole on the shard that holds most of
the unit and has room for it, else on shards filled one after another.  The other
units of several rows then move as a whole to the shard with most of their
documents among those with room.  At the end rows over a shard's quota go to
shards below it, unlinked documents first and heavy units never; counts then
differ by one at most and slots follow without gaps.

Scale: a key with a third of all rows is pre-aggregated where it is read; its
counts, as those of at most ``HEAVY`` such keys, reach its rows by broadcast,
the other keys' by shuffle, so no task holds a hot key and pairs of neighbours
are never made.  Rows without a neighbour take no part in the rounds.  Only
counts of heavy units, of shards and of pairs of shards reach the driver.  Slots
and ranks are cell offset + rank within a cell; cells are hash ranges.

Defined cases: null texts are equal to each other and have size 1 and crc32 0;
an empty text is a text like others; texts count by digest and length only, so
very long ones cost no more; repeated rows are documents of their own; a group
larger than a shard is split over as few shards as the quotas allow; null keys
link nothing; no documents gives no rows; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablestats.llm.common import dropped, text_or_empty, written

SHARDS = 8
ROUNDS = 4
#: Units or keys with at least 1 / HEAVY of all rows or edges go their own way.
HEAVY = 256
CELLS = 1024
#: How a row is held to its shard, in the order of slots.
HOT, LINKED, UNLINKED = 0, 1, 2


def equal_text_key() -> Column:
    """One key per distinct text; null texts share one."""
    return F.when(F.col("text").isNull(), F.lit(b"null")).otherwise(F.unhex(F.md5(F.col("text").cast("binary"))))


def _draw(*cols) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 20)) / F.lit(float(1 << 20))


def _heavy_places(groups: list[tuple[object, list[int]]], room: list[int]) -> list[tuple[object, int, int, int]]:
    """``(link, first rank, one past the last, shard)``; takes the rows placed from ``room``."""
    out = []
    for link, lies in sorted(groups, key=lambda g: (-sum(g[1]), bytes(g[0]))):
        left, at = sum(lies), 0
        while left:
            whole = [s for s in range(len(room)) if room[s] >= left]
            if whole:
                s = max(whole, key=lambda s: (lies[s], -room[s], -s))
            else:
                s = max(range(len(room)), key=lambda s: (room[s], lies[s], -s))
            n = min(left, room[s])
            out.append((link, at, at + n, s))
            room[s], left, at = room[s] - n, left - n, at + n
    return out


def _best(lies: Column, link: Column, among: list[int]) -> Column:
    """The shard of ``among`` with most of a key's documents."""
    return F.array_max(F.array(*[F.struct(lies[s].alias("n"), F.xxhash64(link, F.lit(s)).alias("h"),
                                          F.lit(s).alias("s")) for s in among]))["s"]


def _light_places(groups: DataFrame, room: list[int], rounds: int) -> Column:
    """The shard of each key of ``groups`` (``link, lies, total``) within ``room``, as a column."""
    place = F.lit(None).cast("int")
    for k in range(rounds):
        held = groups.groupBy(place.alias("s")).agg(F.sum("total").alias("n")).collect()
        if all(r["s"] is not None for r in held):
            return place
        left = list(room)
        for r in held:
            if r["s"] is not None:
                left[r["s"]] -= r["n"]
        among = [s for s in range(len(room)) if left[s] > 0]
        if not among:
            break
        want = _best(F.col("lies"), F.col("link"), among)
        asked = {r["s"]: r["n"] for r in groups.where(place.isNull()).groupBy(want.alias("s"))
                 .agg(F.sum("total").alias("n")).collect()}
        if k < rounds - 1:
            chance = F.element_at(F.array(*[F.lit(min(1.0, max(left[s], 0) / max(asked.get(s, 0), 1)))
                                            for s in range(len(room))]), want + 1)
            place = F.coalesce(place, F.when(_draw(F.lit(k), "link") < chance, want))
        else:  # the last refused keys are dealt out by the room left
            total, deal = sum(left[s] for s in among), F.lit(among[-1])
            for s in reversed(among[:-1]):
                at = sum(left[x] for x in among if x <= s)
                deal = F.when(_draw(F.lit(k), "link") < F.lit(at / total), F.lit(s)).otherwise(deal)
            place = F.coalesce(place, deal)
    return F.coalesce(place, _best(F.col("lies"), F.col("link"), list(range(len(room)))))


def _admitted(wanted: list[list[int]], room: list[int]) -> list[list[float]]:
    """Shares of the wanted moves (from, to) that keep every shard within its room.

    Moves out of a shard make room in it.  Shares only fall, so the passes settle;
    the last one counts no room that a later refusal could take back."""
    shards = range(len(room))
    share = [[1.0] * len(room) for _ in shards]
    for last in [False] * 32 + [True]:
        flow = [[wanted[a][b] * share[a][b] for b in shards] for a in shards]
        for b in shards:
            into = sum(flow[a][b] for a in shards)
            fits = max(room[b] + sum(flow[b]) * (0.98 if last else 1.0), 0.0)
            if into > fits:
                for a in shards:
                    share[a][b] *= fits / into
    return share


def _shares_out(share: list[list[float]]) -> Column:
    """The admitted share of a move from ``shard`` to ``best``."""
    return F.element_at(F.element_at(F.array(*[F.array(*[F.lit(x) for x in row]) for row in share]),
                                     F.col("shard") + 1), F.col("best") + 1)


def _pairs(n: Column) -> Column:
    return n.cast("double") * (n - 1) / 2


def label_rounds(labels: DataFrame, edges: DataFrame, *, shards: int = SHARDS,
                 rounds: int = ROUNDS) -> tuple[DataFrame, list[tuple[int, float, float, int]]]:
    """``row, shard`` after the rounds, and per round ``(round, cut, pairs, moved)``.

    ``labels``: ``row, shard`` of all rows; ``edges``: ``row, key``.  Both are stored
    tables.  ``cut`` counts pairs of rows with one key that lie on different shards
    before the round's moves, ``pairs`` all such pairs; both as doubles.  The last
    entry of the report moves nothing: it states the cut that is left.
    """
    n = labels.count()
    quota = [n // shards + (s < n % shards) for s in range(shards)]
    keys = written(edges.groupBy("key").agg(F.count("*").alias("total")).where("total > 1"), "keys")
    bound = max(2, -(-edges.count() // HEAVY))  # at most HEAVY keys reach it
    hot = written(keys.where(F.col("total") >= bound).select("key"), "hot")
    hot_edges = edges.join(F.broadcast(hot), "key", "left_semi").withColumn("hot", F.lit(True))
    light = keys.where(F.col("total") < bound).select("key")
    edges = written(hot_edges.unionByName(edges.join(light, "key", "left_semi").withColumn("hot", F.lit(False))), "edges")
    dropped(keys)
    linked = written(labels.join(edges.select("row").distinct(), "row", "left_semi"), "linked")
    loose = labels.join(linked.select("row"), "row", "left_anti")
    held = {r["shard"]: r["n"] for r in labels.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    report: list[tuple[int, float, float, int]] = []
    for k in range(rounds + 1):
        lying = edges.join(linked, "row")
        lies = written(lying.groupBy("key", "hot").agg(
            F.count("*").alias("total"),
            *[F.count(F.when(F.col("shard") == s, 1)).alias(f"n{s}") for s in range(shards)]), "lies")
        whole = lies.agg(F.sum(_pairs(F.col("total"))).alias("pairs"),
                         F.sum(sum((_pairs(F.col(f"n{s}")) for s in range(shards)), F.lit(0.0))).alias("kept")).first()
        pairs, cut = whole["pairs"] or 0.0, (whole["pairs"] or 0.0) - (whole["kept"] or 0.0)
        if k == rounds or not cut:
            report.append((k, cut, pairs, 0))
            dropped(lies)
            break
        counts = [f"n{s}" for s in range(shards)]
        few = F.broadcast(lies.where("hot").select("key", *counts))  # at most HEAVY keys
        many = lies.where(~F.col("hot")).select("key", *counts)
        seen = (edges.where("hot").join(few, "key").unionByName(edges.where(~F.col("hot")).join(many, "key"))
                .groupBy("row").agg(F.min("key").alias("key"), F.max("hot").alias("hot"), F.count("*").alias("times"),
                                    *[F.sum(c).alias(c) for c in counts]))
        # Every key has counted the row itself; it is to count once.
        again = {c: F.when(F.col("shard") == s, F.col("times") - 1).otherwise(0) for s, c in enumerate(counts)}
        best = F.array_max(F.array(*[F.struct((F.col(c) - again[c]).alias("n"), F.xxhash64("key", F.lit(s)).alias("h"),
                                              F.lit(s).alias("s")) for s, c in enumerate(counts)]))["s"]
        wishes = written(linked.join(seen, "row").select("row", "shard", "key", "hot", best.alias("best"))
                         .where("best <> shard"), "wishes")
        wanted = [[0] * shards for _ in range(shards)]
        for r in wishes.groupBy("shard", "best").agg(F.count("*").alias("n")).collect():
            wanted[r["shard"]][r["best"]] = r["n"]
        share = _admitted(wanted, [quota[s] - held.get(s, 0) for s in range(shards)])
        # Rows of a key go together, those of a hot key one by one.
        lot = F.when(F.col("hot"), F.xxhash64("row", F.lit(k))).otherwise(F.xxhash64("key", F.lit(k)))
        moves = wishes.where(F.pmod(lot, F.lit(1 << 20)) / F.lit(float(1 << 20)) < _shares_out(share))
        after = written(linked.join(moves.select("row", "best"), "row", "left")
                        .select("row", F.coalesce("best", "shard").alias("shard"),
                                F.col("best").isNotNull().alias("moved")), f"labels-{k}")
        moved = after.where("moved").count()
        report.append((k, cut, pairs, moved))
        for r in after.groupBy("shard").agg(F.count("*").alias("n")).collect():
            held[r["shard"]] = held.get(r["shard"], 0) + r["n"]
        for r in linked.groupBy("shard").agg(F.count("*").alias("n")).collect():
            held[r["shard"]] -= r["n"]
        for old in (lies, wishes):
            dropped(old)
        linked = after.select("row", "shard")
        if not moved:
            break
    linked = linked.withColumn("linked", F.lit(True))
    return linked.unionByName(loose.withColumn("linked", F.lit(False))), report


def propagate(nodes: DataFrame, *, shards: int = SHARDS, rounds: int = ROUNDS, cells: int = CELLS) -> DataFrame:
    """``nodes`` (any columns, ``doc_id`` and a binary ``link``) with ``shard`` and ``slot``.

    An array ``links`` names further keys of a row; without it, ``link`` is the
    only one.  Counts per shard differ by one at most; slots run from 0 without
    gaps in each shard.
    """
    return _placed(*_labelled(nodes, shards, rounds)[:2], shards=shards, rounds=rounds, cells=cells)


def propagation_report(nodes: DataFrame, *, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``round, cut, pairs, moved`` of ``propagate``'s rounds: a row a round."""
    report = _labelled(nodes, shards, rounds)[2]
    return nodes.sparkSession.createDataFrame(report, "round int, cut double, pairs double, moved long")


def _labelled(nodes: DataFrame, shards: int, rounds: int) -> tuple[DataFrame, DataFrame, list]:
    keep = [c for c in nodes.columns if c != "links"]
    state = written(nodes.withColumns({
        "row": F.monotonically_increasing_id(),
        "shard": F.pmod(F.xxhash64("doc_id", "link"), F.lit(shards)).cast("int")}), "labels-0")
    keys = F.array("link")
    if "links" in nodes.columns:
        keys = F.array_distinct(F.concat(keys, F.coalesce("links", F.array().cast("array<binary>"))))
    edges = written(state.select("row", F.explode(keys).alias("key")).where("key is not null"), "keyed")
    labels, report = label_rounds(state.select("row", "shard"), edges, shards=shards, rounds=rounds)
    dropped(edges)
    return state.select(*keep, "row"), labels, report


def _placed(nodes: DataFrame, labels: DataFrame, *, shards: int, rounds: int, cells: int) -> DataFrame:
    """Units are kept together and quotas made exact, starting from the labels of the rounds."""
    state = written(nodes.join(labels, "row"), "propagated")
    n = state.count()
    quota = [n // shards + (s < n % shards) for s in range(shards)]
    groups = written(state.groupBy("link").agg(
        F.count("*").alias("total"),
        F.array(*[F.count(F.when(F.col("shard") == s, 1)) for s in range(shards)]).alias("lies"))
        .where("total > 1"), "groups")
    hot = F.col("total") >= F.lit(max(2, -(-n // HEAVY)))  # HEAVY keys at most
    room = list(quota)
    places = _heavy_places([(r["link"], r["lies"]) for r in groups.where(hot).select("link", "lies").collect()], room)
    places = F.broadcast(state.sparkSession.createDataFrame(places, "link binary, at long, until long, place int"))
    light = groups.where(~hot)
    light = light.select("link", _light_places(light, room, rounds).alias("place"))

    # Rows that repeat differ by number alone: it spreads them over cells.
    heavy = (state.join(F.broadcast(groups.where(hot).select("link")), "link", "left_semi")
             .withColumn("cell", F.pmod(F.xxhash64("row", "link"), F.lit(cells)).cast("int")))
    before = Window.partitionBy("link").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (heavy.groupBy("link", "cell").agg(F.count("*").alias("n"))
               .select("link", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    heavy = (heavy.withColumn("inside", F.row_number().over(Window.partitionBy("link", "cell").orderBy("row")) - 1)
             .join(offsets, ["link", "cell"]).withColumn("rank", F.col("start") + F.col("inside"))
             .join(places, "link").where("rank >= at and rank < until")
             .withColumns({"shard": F.col("place"), "kind": F.lit(HOT)}))
    others = (state.join(F.broadcast(groups.where(hot).select("link")), "link", "left_anti").join(light, "link", "left")
              .withColumn("kind", F.when(F.col("place").isNull() & ~F.col("linked"), F.lit(UNLINKED))
                          .otherwise(F.lit(LINKED)))
              .withColumn("shard", F.coalesce("place", "shard")))
    keep = [*nodes.columns, "shard", "kind"]
    settled = written(heavy.select(*keep).unionByName(others.select(*keep)), "labels")
    dropped(state)
    return _balanced(settled, quota, cells)


def _balanced(labels: DataFrame, quota: list[int], cells: int) -> DataFrame:
    """Rows past a shard's quota fill other shards' gaps: unlinked first, then whole keys."""
    shards = len(quota)
    spread = F.when(F.col("kind") == LINKED, F.xxhash64("link")).otherwise(F.xxhash64("row", "link"))
    rows = labels.withColumn("cell", F.pmod(spread, F.lit(cells)).cast("int"))
    counts = written(rows.groupBy("shard", "kind", "cell").agg(F.count("*").alias("n")), "cells")
    held = [0] * shards
    for r in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect():
        held[r["shard"]] = r["n"]

    before = Window.partitionBy("shard").orderBy("kind", "cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "kind", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "kind", "cell").orderBy("link", "doc_id", "row")
    ranked = (rows.withColumn("inside", F.row_number().over(inside) - 1)
              .join(offsets, ["shard", "kind", "cell"])
              .withColumn("slot", (F.col("start") + F.col("inside")).cast("long")))
    at, spare, over = 0, F.lit(None).cast("long"), F.lit(False)
    for s in range(shards):
        if held[s] > quota[s]:
            late = (F.col("shard") == s) & (F.col("slot") >= quota[s])
            spare = F.when(late, F.col("slot") - quota[s] + at).otherwise(spare)
            over, at = over | late, at + held[s] - quota[s]
    ranked = ranked.withColumns({"spare": spare, "over": over})
    at, shard, slot = 0, F.col("shard"), F.col("slot")
    for s in range(shards):
        if held[s] < quota[s]:
            here = F.col("over") & F.col("spare").between(at, at + quota[s] - held[s] - 1)
            shard = F.when(here, F.lit(s)).otherwise(shard)
            slot = F.when(here, F.col("spare") - at + held[s]).otherwise(slot)
            at += quota[s] - held[s]
    keep = [c for c in labels.columns if c not in ("shard", "kind", "row")]
    return ranked.select(*keep, shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def shard_documents(docs: DataFrame, *, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``; law ``rows``."""
    body = text_or_empty().cast("binary")
    nodes = docs.select("doc_id", (F.octet_length(body) + 1).cast("long").alias("size"),
                        F.crc32(body).alias("text_crc32"), equal_text_key().alias("link"))
    return propagate(nodes, shards=shards, rounds=rounds).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
