"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are hashed, k-grams of word hashes are combined, and of every window of
k-grams the smallest hash is kept, once per run of windows that share it.  Two
texts that share a whole window of ``WINDOW`` words keep the same minimum there,
so joining the kept minima loses no shared window (window of k-grams =
``WINDOW - k + 1``).  Each run carries the hashes of its own windows: a run whose
minimum is known to the benchmark is extended by joining these, and the covered
words of a document are the union of its matching windows.  An item shorter
than ``WINDOW`` words is one window of its length, found the same way, one pass
per length that occurs.  Matches compare 64-bit hashes of whole windows as well
as of the minimum.

Scale: documents are read once and never shuffled as text; a document sends one
sentinel row plus its few matching runs to the grouping on (doc_id, text hash).
Benchmark sides are counted and broadcast within ``BROADCAST_ROWS``, beyond it
the same joins shuffle.  The benchmark's minima are distinct, so a passage in
many items and many documents is not paired up; the items of a document come
from classes of windows with the same set of items.

Defined cases: a null or wordless text has no words, no hit and is clean; items
without words match nothing; repeated items (one item_id) are one item, and a
null item_id is the empty id; repeated documents get one row each; an empty
benchmark leaves every document clean; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablestats.llm.common import LOWER, UPPER, same_row, small_side, text_or_empty, written

WINDOW = 13
GRAM = 5
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_hashes(text: str = "text") -> Column:
    words = F.split(F.translate(text_or_empty(text), UPPER, LOWER), BREAK)
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _with_grams(df: DataFrame, length: int, k: int) -> DataFrame:
    """Adds ``n_win`` and, per window of ``length`` words, its minimum and its hash."""
    shown = F.greatest(F.col("n_words") - k + 1, F.lit(0))
    grams = F.transform(F.slice("h", F.lit(1), shown),
                        lambda x, i: F.xxhash64(x, *[F.get("h", i + j) for j in range(1, k)]))
    if k == 1:
        grams = F.col("h")
    n_win = F.greatest(F.col("n_words") - length + 1, F.lit(0))
    offsets = sorted({*range(k, length - k, k), length - k} - {0})  # k-grams that cover the window
    df = df.withColumn("g", grams).withColumn("n_win", n_win)
    first = F.slice("g", F.lit(1), F.col("n_win"))
    least = F.transform(first, lambda x, i: F.array_min(F.slice("g", i + 1, F.lit(length - k + 1))))
    whole = F.transform(first, lambda x, i: F.xxhash64(F.lit(length), x, *[F.get("g", i + j) for j in offsets]))
    return df.withColumns({"least": least, "whole": whole})


def _with_runs(df: DataFrame, length: int, k: int, out: str) -> DataFrame:
    """Adds ``out``: per run of windows with one minimum, that minimum, start and window hashes."""
    df = _with_grams(df, length, k)
    starts = F.when(F.col("n_win") > 0, F.filter(
        F.sequence(F.lit(0), F.greatest(F.col("n_win") - 1, F.lit(0))),
        lambda i: (i == 0) | (F.get("least", i) != F.get("least", i - 1)))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("starts", starts)
    runs = F.transform("starts", lambda s, r: F.struct(
        F.lit(length).alias("length"), F.get("least", s).alias("least"), s.alias("start"),
        F.slice("whole", s + 1, F.coalesce(F.get("starts", r + 1), F.col("n_win")) - s).alias("whole")))
    return df.withColumn(out, runs).drop("g", "n_win", "least", "whole", "starts")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``length, least, whole, item``: every window of every item."""
    items = (benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                              word_hashes().alias("h"))
             .withColumn("n_words", F.size("h")).where("n_words > 0")
             .withColumn("length", F.least(F.col("n_words"), F.lit(window))))
    items = written(items, "items")
    out = None
    for (length,) in sorted(items.select("length").distinct().collect()):  # window values at most
        k = min(GRAM, length)
        part = _with_grams(items.where(F.col("length") == length), length, k).select(
            "length", "item", F.explode(F.arrays_zip("least", "whole")).alias("w")
        ).select("length", "w.least", "w.whole", "item").distinct()
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = items.sparkSession.createDataFrame([], "length int, item string, least long, whole long")
    return written(out.select("length", "least", "whole", "item"), "windows")


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """``doc_id, row, n_words, n_hit, n_items, items_sha256, contaminated`` per document.

    ``row`` is a hash of the text, for telling rows of one id apart.
    """
    windows = benchmark_windows(benchmark, window)
    # A class is a set of items, told by order-free sums of its members' hashes.
    classes = windows.groupBy("length", "whole").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("item")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(1), "item")).alias("y"))
    classes = written(classes.select("length", "whole", F.xxhash64("n", "x", "y").alias("class")), "classes")
    members = written(windows.join(classes, ["length", "whole"]).select("class", "item").distinct(), "members")
    minima = written(windows.select("length", "least").distinct().withColumn("known", F.lit(True)), "minima")
    n_minima, n_classes, n_members = minima.count(), classes.count(), members.count()
    lengths = [r[0] for r in minima.select("length").distinct().collect()]

    rows = docs.select("doc_id", same_row().alias("row"), word_hashes().alias("h"))
    rows = rows.withColumn("n_words", F.size("h"))
    for length in lengths:
        rows = _with_runs(rows, length, min(GRAM, length), f"runs{length}")
    # The sentinel keeps documents without a match; its key only spreads it.
    sentinel = F.array(F.struct(
        F.lit(0).alias("length"), F.xxhash64("doc_id", "row").alias("least"), F.lit(-1).alias("start"),
        F.array().cast("array<bigint>").alias("whole")))
    runs = (rows.select("doc_id", "row", "n_words",
                        F.explode(F.concat(sentinel, *[F.col(f"runs{x}") for x in lengths])).alias("r"))
            .select("doc_id", "row", "n_words", "r.*"))
    hits = (runs.join(small_side(minima, n_minima), ["length", "least"], "left")
            .where("start < 0 or known")
            .select("doc_id", "row", "n_words", "length", "start", F.posexplode_outer("whole").alias("at", "whole"))
            .withColumn("whole", F.coalesce("whole", F.xxhash64("doc_id", "row")))  # spreads the sentinels
            .join(small_side(classes, n_classes), ["length", "whole"], "left")
            .where("start < 0 or class is not null"))
    begin = F.col("start") + F.col("at")
    per_doc = hits.groupBy("doc_id", "row").agg(
        F.max("n_words").alias("n_words"), F.count_if(F.col("start") < 0).alias("rows"),
        F.sort_array(F.collect_set(F.when(F.col("start") >= 0, F.struct(
            begin.alias("a"), (begin + F.col("length")).alias("b"))))).alias("spans"),
        F.collect_set("class").alias("classes"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["b"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(acc["end"], s["a"]))).alias("n")),
        lambda acc: acc["n"])
    items = (per_doc.select("doc_id", "row", "n_words", "rows", covered.alias("n_hit"),
                            F.explode_outer("classes").alias("class"))
             .withColumn("class", F.coalesce("class", F.xxhash64("doc_id", "row")))
             .join(small_side(members, n_members), "class", "left")
             .groupBy("doc_id", "row", "n_words", "rows", "n_hit")
             .agg(F.sort_array(F.collect_set("item")).alias("items")))
    return items.select(
        "doc_id", "row", F.col("n_words").cast("long"), F.col("n_hit").cast("long"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("copy"),
    ).drop("copy")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated."""
    found = written(contamination(docs, benchmark, **how).where("contaminated").select(
        F.col("doc_id").alias("__id"), F.col("row").alias("__row")).distinct(), "contaminated")
    return (docs.select("*", same_row().alias("__text"))
            .join(small_side(found, found.count()),
                  F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__row")), "left_anti")
            .drop("__text"))
