"""Ranked lexical search by NRA: sorted reads only, score intervals, exact results.

A text's score for an item is the sum, over the item's terms with repeats, of
the term's impact in the text (a weight that falls with the number of documents
that hold the term, times a share that grows with its occurrences and falls with
the document's length; whole numbers throughout).  Postings, one for each document
and term of an item, are stored in blocks of falling impact.  A round reads the
next block and never goes back: every (item, document) met so far keeps a lower
score, the sum of the impacts seen, and an upper one, which adds for each term not
seen the largest impact still unread in that term's list.  The item's k-th
largest lower score is its threshold.  Pairs whose upper score is below
it are dropped; an item whose unread impacts add up to less than it is closed,
so that from then on blocks are read for its remaining documents only.  Reading
goes on until both scores of every remaining pair are equal and no item is open:
membership, ties and scores are then exact.

Scale: texts are read once, in one pass that gives counts of the items' terms
and never moves a text.  Documents with equal counts have equal scores for every
item, so such a class (a group of copies, whatever its size) has one set of
postings, its size, and its k smallest ids.  Blocks are cut, from a histogram of
impacts, so that the pairs that a read can make grow fourfold from one to the
next; a common word's list is spread over many tasks and mostly read when its
items are closed.  The items' side is counted, and broadcast within
``BROADCAST_ROWS`` rows; beyond that the same joins shuffle.  The driver gets
totals and one number per grade of impact (some hundreds).

Defined cases: a null or wordless text is no document, a null or wordless item
has no results; rows with one item_id and one text are one item, with different
texts several; repeated documents are as many documents; equal scores go by
doc_id, null first; no documents or no items give an empty result; texts of any
length are counted whole; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablestats.llm.common import LOWER, UPPER, dropped, small_batches, small_side, text_or_empty, written

TOP = 10
#: What no term holds; its bytes are the same in UTF-8.
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: (item, class) pairs that the first read can make for each place of a result; each later read: ``GROWTH`` times more.
FIRST_PAIRS = 32
GROWTH = 4
#: Grades of impact to a factor of two.
GRADES = 4
#: Terms of an item whose marks share one whole number.
MARKS = 62
#: Terms up to which the vocabulary goes to the tasks that count.
VOCABULARY = 200_000

COUNTED = "doc_id long, n long, key binary, words array<{}>, counts array<int>"


def _folded_bytes() -> bytes:
    """A table for ``bytes.translate``: term bytes as they are, capitals lowered, all others a space."""
    keep = [b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)]
    return bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in keep)


class TermCounts:
    """Batches of (doc_id, text bytes) to rows of ``COUNTED``: terms of ``vocabulary`` (all, if None) and their counts."""

    def __init__(self, vocabulary):
        self.vocabulary = vocabulary

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = _folded_bytes(), self.vocabulary and self.vocabulary.value
        kind = pa.int32() if known is not None else pa.string()
        for batch in batches:
            sizes, keys, words, counts = [], [], [], []
            for text in batch.column(1):
                found = text.as_py().translate(table).split()
                met = Counter(found if known is None else map(known.get, found))
                met.pop(None, None)
                own = sorted(met)
                times = [met[w] for w in own]
                sizes.append(len(found))
                keys.append(hashlib.blake2b(repr((len(found), own, times)).encode(), digest_size=16).digest())
                words.append(own if known is not None else [w.decode() for w in own])
                counts.append(times)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(words, pa.list_(kind)),
                 pa.array(counts, pa.list_(pa.int32()))], ["doc_id", "n", "key", "words", "counts"])


def terms(text: str = "text") -> Column:
    """The terms of a text, in order, with repeats."""
    return F.filter(F.split(F.translate(text_or_empty(text), UPPER, LOWER), BREAK), lambda t: t != "")


def _queries(items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Items (item, item_id), words (word, t) and queries (item, t, slot, times); slots count an item's terms."""
    stored = written(items.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text")).distinct(), "items")
    named = written(stored.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"), "named")
    dropped(stored)
    each = named.select("item", F.explode(terms()).alias("word")).groupBy("item", "word").agg(F.count(F.lit(1)).alias("times"))
    words = written(each.select("word").distinct(), "words")
    # Numbered without gaps from the sizes of the parts, of which there are as many as shuffle partitions.
    part, row = F.spark_partition_id(), F.monotonically_increasing_id()
    mixed = written(words.select("word", part.alias("part"), row.bitwiseAND(F.lit((1 << 33) - 1)).alias("row")), "mixed")
    dropped(words)
    starts, start = [], 0
    for r in mixed.groupBy("part").count().orderBy("part").collect():
        starts.append((r["part"], start))
        start += r["count"]
    starts = items.sparkSession.createDataFrame(starts, "part int, start long")
    numbered = written(mixed.join(F.broadcast(starts), "part").select("word", (F.col("start") + F.col("row")).cast("int").alias("t")), "terms")
    dropped(mixed)
    slot = F.row_number().over(Window.partitionBy("item").orderBy("t")) - 1
    queries = written(each.join(small_side(numbered, numbered.count()), "word").select("item", "t", "times").withColumn("slot", slot), "queries")
    return named.select("item", "item_id"), numbered, queries


def _counted(docs: DataFrame, words: DataFrame) -> DataFrame:
    """``doc_id, n, key, words, counts`` of every document: its size and the counts of the items' terms."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    n_words = words.count()
    if n_words <= VOCABULARY:
        known = {r.word.encode(): r.t for r in words.toLocalIterator()}
        found = texts.mapInArrow(TermCounts(spark.sparkContext.broadcast(known)), COUNTED.format("int"))
        return written(found, "counted")
    every = written(texts.mapInArrow(TermCounts(None), COUNTED.format("string")).withColumn("row", F.monotonically_increasing_id()), "every")
    met = (every.select("row", F.explode(F.arrays_zip("words", "counts")).alias("x"))
           .select("row", F.col("x.words").alias("word"), F.col("x.counts").alias("tf"))
           .join(small_side(words, n_words), "word").groupBy("row")
           .agg(F.sort_array(F.collect_list(F.struct("t", "tf"))).alias("found")))
    none = F.array().cast("array<struct<t:int,tf:int>>")
    full = every.select("row", "doc_id", "n").join(met, "row", "left").withColumn("found", F.coalesce("found", none))
    # Two hashes of all that scores depend on tell classes apart.
    key = F.concat(*[F.hex(F.xxhash64(F.lit(seed), "n", "found")) for seed in (0, 1)]).cast("binary")
    return written(full.select("doc_id", "n", key.alias("key"), F.col("found.t").alias("words"), F.col("found.tf").alias("counts")), "counted")


def _classes(counted: DataFrame, top: int) -> tuple[DataFrame, DataFrame]:
    """Classes (c, n, size, words, counts) of documents with equal counts, and their ``top`` smallest ids (c, doc_id)."""
    useful = counted.where(F.size("words") > 0)
    once = useful.groupBy("key").agg(F.count(F.lit(1)).alias("size"), *[F.first(x).alias(x) for x in ("n", "words", "counts")])
    stored = written(once, "once")
    classes = written(stored.withColumn("c", F.monotonically_increasing_id()), "classes")
    dropped(stored)
    first = F.row_number().over(Window.partitionBy("key").orderBy("doc_id"))
    ids = useful.select("key", "doc_id").withColumn("nth", first).where(F.col("nth") <= top)
    members = written(ids.join(classes.select("key", "c"), "key").select("c", "doc_id"), "members")
    return classes, members


def _impacts(counted: DataFrame, classes: DataFrame, words: DataFrame) -> DataFrame:
    """``c, t, size, impact`` of every class and term with an impact above zero."""
    total = counted.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_docs, n_terms = F.lit(total.docs).cast("long"), F.lit(max(total.terms, 1)).cast("long")
    each = classes.select("c", "n", "size", F.explode(F.arrays_zip("words", "counts")).alias("x")).select(
        "c", "n", "size", F.col("x.words").alias("t"), F.col("x.counts").cast("long").alias("tf"))
    holding = each.groupBy("t").agg(F.sum("size").alias("df"))
    ratio = (2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1).cast("double")
    weights = written(holding.select("t", F.floor(1000 * F.log(ratio)).alias("w")), "weights")

    def div(a: Column, b: Column) -> Column:
        return F.call_function("div", a, b)

    m = F.lit(25).cast("long") + div(75 * F.col("n") * n_docs, n_terms)
    share = div(F.lit(1_000_000_000).cast("long") * F.col("tf"), 1000 * F.col("tf") + 8 * m)
    return (each.join(small_side(weights, weights.count()), "t")
            .select("c", "t", "size", (F.col("w") * share).alias("impact")).where("impact > 0"))


def _grade() -> Column:
    """Falls with the impact: 0 for the largest that a whole number can be."""
    return (F.lit(64 * GRADES) - F.floor(F.log2(F.col("impact").cast("double")) * GRADES)).cast("int")


def _blocks(impacts: DataFrame, queries: DataFrame, n_queries: int, first: int) -> tuple[dict[int, int], DataFrame]:
    """The block of each grade, and ``t, grade, n, most`` (postings and largest impact of a term in a grade)."""
    lists = written(impacts.groupBy("t", _grade().alias("grade")).agg(F.count(F.lit(1)).alias("n"), F.max("impact").alias("most")), "lists")
    askers = queries.groupBy("t").agg(F.count(F.lit(1)).alias("items"))
    work = (lists.join(small_side(askers, n_queries), "t").groupBy("grade")
            .agg(F.sum(F.col("n") * F.col("items")).alias("pairs")).orderBy("grade").collect())
    blocks, block, pairs, most = {}, 0, 0, first
    for r in work:
        if pairs and pairs + r.pairs > most:
            block, pairs, most = block + 1, 0, most * GROWTH
        blocks[r.grade] = block
        pairs += r.pairs
    return blocks, lists


def _mask(seen: list[str]) -> list[Column]:
    """One whole number per ``MARKS`` slots, the slot's bit set in its own."""
    slot = F.col("slot")
    return [F.when(F.floor(slot / MARKS) == j, F.call_function("shiftleft", F.lit(1).cast("long"), (slot % MARKS).cast("int")))
            .otherwise(F.lit(0).cast("long")).alias(name) for j, name in enumerate(seen)]


def _unread(queries: DataFrame, lists: DataFrame, block: int) -> DataFrame:
    """``item, rests, open_rest``: per slot, and summed, the most that an unread posting can still add."""
    most = lists.where(F.col("block") > block).groupBy("t").agg(F.max("most").alias("most"))
    each = queries.join(most, "t", "left").withColumn("rest", F.col("times") * F.coalesce("most", F.lit(0)))
    return each.groupBy("item").agg(F.sort_array(F.collect_list(F.struct("slot", "rest")))["rest"].alias("rests"),
                                    F.sum("rest").alias("open_rest"))


def search(docs: DataFrame, items: DataFrame, top: int = TOP, first_pairs: int = FIRST_PAIRS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents above score 0 of every item."""
    named, words, queries = _queries(items)
    n_queries = queries.count()
    sizes = queries.agg(F.coalesce(F.max("slot"), F.lit(0)).alias("slots"), F.countDistinct("item").alias("items")).first()
    counted = _counted(docs, words)
    classes, members = _classes(counted, top)
    impacts = _impacts(counted, classes, words)
    blocks, lists = _blocks(impacts, queries, n_queries, first_pairs * top * max(sizes.items, 1))
    spark = docs.sparkSession
    graded = F.broadcast(spark.createDataFrame(sorted(blocks.items()), "grade int, block int"))  # some hundreds of rows
    lists = written(lists.join(graded, "grade").groupBy("t", "block").agg(F.max("most").alias("most")), "bounds")
    postings = written(impacts.withColumn("grade", _grade()).join(graded, "grade")
                       .select("block", "c", "t", F.least("size", F.lit(top)).cast("int").alias("size"), "impact")
                       .sortWithinPartitions("block", F.desc("impact")), "postings", by=("block",))
    dropped(counted)
    dropped(classes)
    asked = small_side(queries.select("item", "t", "slot", "times"), n_queries)
    seen = [f"seen{j}" for j in range(sizes.slots // MARKS + 1)]
    pair = ["item", "c"]
    state = limits = None
    open_items = True
    for block in range(max(blocks.values(), default=-1) + 1):
        read = postings.where(F.col("block") == block).select("c", "t", "size", "impact")
        rows = []
        if open_items:
            wanted = asked if limits is None else asked.join(small_side(limits.where("open").select("item"), sizes.items), "item")
            rows.append(read.join(wanted, "t"))
        if state is not None:
            known = state.select(*pair).join(small_side(limits.where("not open").select("item"), sizes.items), "item")
            rows.append(read.join(small_side(known, n_state), "c").join(asked, ["item", "t"]))
        new = [r.select(*pair, "size", (F.col("times") * F.col("impact")).alias("low"), *_mask(seen)) for r in rows]
        if state is not None:
            new.append(state)
        every = new[0]
        for r in new[1:]:
            every = every.unionByName(r)
        met = every.groupBy(*pair).agg(F.max("size").alias("size"), *[F.sum(x).alias(x) for x in ("low", *seen)])
        unread = written(_unread(queries, lists, block), "unread")
        bounds = unread if limits is None else unread.join(limits.select("item", "least"), "item")
        least = F.lit(0) if limits is None else F.col("least")
        marks = F.array(*seen)
        left = F.transform("rests", lambda x, i: F.when(
            F.call_function("shiftright", F.get(marks, F.floor(i / MARKS).cast("int")), (i % MARKS).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 0,
            x).otherwise(F.lit(0).cast("long")))
        high = F.col("low") + F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + x)
        kept = (met.join(small_side(bounds, sizes.items), "item").withColumn("high", high).where(F.col("high") >= least)
                .select(*pair, "size", "low", "high", *seen))
        state = written(kept, f"state{block}")
        if block:
            dropped(stored)
        best = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("low"), "c"))
        leaders = state.select("item", "c", "size", "low").withColumn("nth", best).where(F.col("nth") <= top)
        places = F.sum("size").over(Window.partitionBy("item").orderBy("nth"))
        thresholds = leaders.withColumn("places", places).where(F.col("places") >= top).groupBy("item").agg(F.max("low").alias("least"))
        # Score 0 is no result, so a threshold is 1 at least.
        both = unread.join(thresholds, "item", "left").withColumn("least", F.greatest(F.coalesce("least", F.lit(1)), F.lit(1)))
        limits = written(both.select("item", "least", (F.col("open_rest") >= F.col("least")).alias("open")), "limits")
        stored = state
        state = state.join(small_side(limits.select("item", "least"), sizes.items), "item").where(F.col("high") >= F.col("least"))
        now = state.agg(F.count(F.lit(1)).alias("pairs"), F.count(F.when(F.col("high") > F.col("low"), 1)).alias("unsure")).first()
        n_state, state = now.pairs, state.select(*pair, "size", "low", *seen)
        open_items = limits.where("open").limit(1).count() > 0
        if not open_items and not now.unsure:
            break
    if state is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    placed = members.join(small_side(state.select("item", "c", F.col("low").alias("score")), n_state), "c")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
    ranked = placed.withColumn("rank", rank).where(F.col("rank") <= top)
    return written(ranked.join(small_side(named, sizes.items), "item").select("item_id", "rank", "doc_id", "score"), "ranked")
