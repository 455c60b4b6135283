"""A Merkle manifest of a table: leaf, subtree and root digests with a proof per row.

Every row is a leaf; the leaves of a group, in order, are folded ``arity`` at a
time into one subroot, the subroots in the same way into the root.  A level is
a sibling-shift self-join: a node lists the indices of its siblings (its own
index XOR 1 for binary trees, slot offsets within the run of ``arity``
otherwise) and equijoins the nodes of its level on (group, index); rows of slot
zero, which then hold their whole run, emit the parent.  Once the root stands,
the same join gives every node what stands left and right of it, and paths are
joined downwards, parent to child, until each leaf can hash its proof and fold
itself (or a changed version of itself) up to the root.

Scale: a text is hashed where it is read and never moves.  Positions come from
one range sort and the sizes of its partitions, so no group is ordered in one
task; repeated rows are told apart by their row number and spread like any
others.  Nodes of a run share a partition, so the joins of a level cost one
shuffle of its narrow rows, and a level has an ``arity``-th of the rows below
it.  Only the number of groups, the largest group's size and the root reach the
driver.  Tables of the levels, on the way up and on the way down, are written to
the shared folder and dropped, so the driver plans one level at a time.

Defined cases: a null field is hashed as ``-``, an empty one as ``0:``; rows of a null
group are a group of their own, the first; a null order value comes first; rows
with equal order are ordered by leaf, and equal rows are as many leaves; a lone
leaf is its group's subroot, a lone subroot the root, with an empty proof (the
digest of no text); an empty table gives an empty result; long texts are hashed
whole; columns not named are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestats.llm.common import LOWER, UPPER, dropped, id_remainder, small_side, written

ARITY = 16
#: Row number and partition of ``monotonically_increasing_id``.
ROW_BITS = 33


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts' concatenation."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Sequence[Column]) -> Column:
    return digest(*[field(v) for v in values])


@contextmanager
def runs_together(spark: SparkSession) -> Iterator[None]:
    """Lets a join on (group, parent, index) use rows dealt by (group, parent); the setting is put back."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def positioned(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` (a stored table) with ``at``: each row's place, from 0, in the order of ``order`` (nulls first).

    Rows equal in ``order`` stand in the order of their row numbers.  Written, as are all positions."""
    rows = df.withColumn("tie", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(*order, "tie").sortWithinPartitions(*order, "tie")
    placed = written(ranged.drop("tie").withColumn("place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("place", ROW_BITS)
    starts, start = [], 0  # as many as partitions of the shuffle
    for r in placed.groupBy(part.alias("part")).count().orderBy("part").collect():
        starts.append((r["part"], start))
        start += r["count"]
    offsets = df.sparkSession.createDataFrame(starts, "part long, start long")
    at = F.col("start") + F.col("place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    out = (placed.withColumn("part", part).join(F.broadcast(offsets), "part")
           .withColumn("at", at).drop("part", "place", "start"))
    out._corpus_path = placed._corpus_path
    return out


def sibling_indices(index: Column, arity: int) -> Column:
    """A node's own index, then its siblings': index XOR 1 in binary trees, else the other slots of its run."""
    if arity == 2:
        return F.array(index, index.bitwiseXOR(F.lit(1).cast("long")))
    first = index - index % arity
    return F.transform(F.sequence(F.lit(0), F.lit(arity - 1)),
                       lambda offset: first + (index % arity + offset) % arity)


def with_siblings(nodes: DataFrame, arity: int, carry: Sequence[str] = (), firsts_only: bool = False) -> DataFrame:
    """``nodes`` (grp, index, n, digest) with ``left`` and ``right``: the digests beside each in its run, concatenated.

    ``firsts_only`` keeps the nodes of slot zero alone."""
    dealt = nodes.withColumn("parent", F.floor(F.col("index") / arity)).repartition("grp", "parent")
    asking = dealt.where(F.col("index") % arity == 0) if firsts_only else dealt
    asking = asking.select("grp", "parent", "index", F.explode(sibling_indices(F.col("index"), arity)).alias("sibling"))
    answers = dealt.select("grp", "parent", F.col("index").alias("sibling"), "n", "digest", *carry)
    own = F.col("sibling") == F.col("index")
    met = asking.join(answers, ["grp", "parent", "sibling"]).groupBy("grp", "parent", "index").agg(
        F.sort_array(F.collect_list(F.struct("sibling", "digest"))).alias("run"),
        F.max(F.when(own, F.col("n"))).alias("n"), F.max(F.when(own, F.col("digest"))).alias("digest"),
        *[F.max(F.when(own, F.col(c))).alias(c) for c in carry])

    def beside(keep) -> Column:
        return F.array_join(F.transform(F.filter("run", lambda x: keep(x["sibling"])), lambda x: x["digest"]), "")

    return met.select("grp", "parent", "index", "n", "digest", *carry,
                      beside(lambda i: i < F.col("index")).alias("left"),
                      beside(lambda i: i > F.col("index")).alias("right"))


def levels_of(nodes: DataFrame, largest: int, arity: int) -> list[DataFrame]:
    """The tables of all levels, from ``nodes`` up; ``largest``: nodes of the largest group.

    A group is in a table as long as it has nodes to fold, and once more as its lone last node."""
    out = [nodes]
    while largest > 1:
        full = with_siblings(out[-1].where("n > 1"), arity, firsts_only=True)
        parents = full.select("grp", F.col("parent").alias("index"), F.ceil(F.col("n") / arity).alias("n"),
                              digest(F.col("digest"), F.col("right")).alias("digest"))
        out.append(written(parents, f"level{len(out)}"))
        largest = -(-largest // arity)
    return out


def tops_of(levels: Sequence[DataFrame]) -> DataFrame:
    """``grp, digest``: the last node of every group."""
    ends = [level.where("n = 1").select("grp", "digest") for level in levels]
    out = ends[0]
    for e in ends[1:]:
        out = out.unionByName(e)
    return out


def paths_of(levels: Sequence[DataFrame], ends: DataFrame, arity: int,
             carry: Sequence[str] = ()) -> tuple[DataFrame, list[DataFrame]]:
    """The lowest level's nodes with ``path``: what stands left and right of them and of each ancestor.

    ``ends`` (grp, path, and more columns, which are handed down) is what the last node of each group begins with.
    The levels above the lowest are written one by one, so that no plan holds more than one
    level's joins; the written tables come second."""
    more = [c for c in ends.columns if c not in ("grp", "path")]
    out, tables = None, []
    for k in range(len(levels) - 1, -1, -1):
        kept = list(carry) if k == 0 else []
        own = levels[k].where("n = 1").join(ends, "grp").select("grp", "index", "digest", *kept, "path", *more)
        if out is not None:
            up = out.select("grp", F.col("index").alias("parent"), F.col("path").alias("above"), *more)
            step = F.array(F.struct("left", "right"))
            below = (with_siblings(levels[k].where("n > 1"), arity, kept).join(up, ["grp", "parent"])
                     .select("grp", "index", "digest", *kept, F.concat(step, "above").alias("path"), *more))
            own = own.unionByName(below)
        if k:
            own = written(own, f"paths{k}")
            tables.append(own)
        out = own
    return out, tables


def manifest(df: DataFrame, fields: Sequence[str], group: str, order: str, arity: int = ARITY,
             changed: Column | None = None) -> DataFrame:
    """``order, group, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    ``fields`` are hashed into the leaf.  ``changed``, where not null, is the digest of
    the row as it is found later (``leaf`` builds it): ``folded_root`` is what the
    proof makes of it, ``verified`` whether that is the root."""
    if arity < 2:
        raise ValueError("a run has two nodes at least")
    spark = df.sparkSession
    hashed = df.select(F.col(group).alias("name"), F.col(order).alias("key"), leaf([F.col(c) for c in fields]).alias("digest"),
                       (F.lit(None) if changed is None else changed).cast("string").alias("changed"))
    leaves = written(hashed, "leaves")
    placed = positioned(leaves, ["name", "key", "digest"])
    dropped(leaves)
    groups = written(placed.groupBy("name").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")), "groups")
    ranked = positioned(groups, ["name"])
    size = ranked.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.max("n"), F.lit(0)).alias("largest")).first()
    with runs_together(spark):
        named = small_side(ranked.select("name", "first", "n", F.col("at").alias("grp")), size.groups)
        nodes = (placed.alias("p").join(named.alias("g"), F.col("p.name").eqNullSafe(F.col("g.name")))
                 .select("grp", (F.col("at") - F.col("first")).alias("index"), "n", "digest", "key", F.col("p.name").alias("name"), "changed"))
        base = written(nodes, "nodes")
        levels = levels_of(base, size.largest, arity)
        tops = written(tops_of(levels).select(F.lit(0).cast("long").alias("grp"), F.col("grp").alias("index"),
                                              F.lit(size.groups).cast("long").alias("n"), "digest"), "subroots")
        upper = levels_of(tops, size.groups, arity)
        root = tops_of(upper).first()
        # The path of a subroot begins with nothing above the root.
        step = "array<struct<left:string,right:string>>"
        start = spark.range(1).select(F.col("id").alias("grp"), F.array().cast(step).alias("path"))
        subroots, above = paths_of(upper, start, arity)
        ends = written(subroots.select(F.col("index").alias("grp"), "path", F.col("digest").alias("subroot")), "ends")
        found, below = paths_of(levels, ends, arity, ["key", "name", "changed"])
        folded = F.aggregate("path", F.coalesce("changed", "digest"),
                             lambda node, at: digest(at["left"], node, at["right"]))
        proof = digest(F.array_join(F.transform("path", lambda at: F.concat(at["left"], at["right"])), ""))
        top = F.lit(root.digest if root else None).cast("string")
        out = found.select(F.col("key").alias(order), F.col("name").alias(group), F.col("digest").alias("leaf"), "subroot",
                           top.alias("root"), proof.alias("proof_sha256"), folded.alias("folded_root"),
                           (folded == top).alias("verified"))
        result = written(out, "manifest")
    for used in (placed, groups, ranked, *levels, *upper, ends, *above, *below):
        dropped(used)
    return result


def documents_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``, by source; checked against a copy in which the
    rows whose id's crc32 5 divides have lost the capitals of their text."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = [F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in fields]
    picked = F.col("doc_id").isNotNull() & (id_remainder("doc_id", 5) == 0)
    out = manifest(docs, fields, "source", "doc_id", changed=F.when(picked, leaf(tampered)))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "source")
