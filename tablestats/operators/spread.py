"""Spread of a value per bucket: mean/median, and box-plot numbers.

The raw values never leave the executors, and with up to ``LOCAL_GROUPS`` buckets
they are not shuffled either: each bucket's state is broadcast (its rows are
counted) and every task aggregates what it reads, so a bucket with a third of
all rows is spread.  Exact whiskers come from the scans that find the quartiles
(``quantiles.exact_box``); only if very many values are tied where a fence lies,
and with sketch quartiles, does a scan of their own find them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestats.functions.clean import known
from tablestats.operators.profile import QUARTILES, SUMMARY_ACCURACY, median, quantiles
from tablestats.operators.quantiles import (
    approx_quantiles,
    attach,
    exact_box,
    exact_quantiles,
    fused_quantiles,
    own_percentiles,
    rel_err_to_k,
    settled,
)

# Fixed value: whisker reach in inter-quartile ranges (box-plot default).
WHISKER_IQR = 1.5


def bucket_stats(df: DataFrame, bucket: str, col: str, exact: bool = False,
                 rel_err: float = 1.0 / SUMMARY_ACCURACY, sketch: str | None = None,
                 method: str | None = None) -> DataFrame:
    """Per non-null bucket: n, mean and median of the non-null values of ``col``."""
    x = known(F.col(col).cast("double"))
    data = df.where(F.col(bucket).isNotNull() & x.isNotNull())
    if fused_quantiles(exact, sketch, method):
        data, (q,) = own_percentiles(data, [x], [[0.5]], [bucket]) if exact else (data, (None,))
        return data.groupBy(bucket).agg(F.count(x).alias("n"), F.avg(x).alias("mean"),
                                        (F.get(q, 0) if exact else median(x, rel_err=rel_err)).alias("median"))
    # Counts, means and sketches in one pass; exact medians take two more.
    got = (exact_quantiles(data, x, [0.5], by=[bucket], method=method) if exact
           else approx_quantiles(data, x, [0.5], by=[bucket], k=rel_err_to_k(rel_err)))
    return got.select(bucket, "n", "mean", F.get("q", 0).alias("median"))


def box_stats(df: DataFrame, bucket: str, col: str, k: float = WHISKER_IQR,
              exact: bool = False, accuracy: int = SUMMARY_ACCURACY,
              sketch: str | None = None, method: str | None = None) -> DataFrame:
    """Box-plot numbers per non-null bucket.

    Output: bucket, q1, median, q3, whisker_low, whisker_high, n_out, n.
    Whiskers reach the most extreme values within ``k`` IQR of the box (never
    inside the box); ``n_out`` counts the values beyond them.
    """
    x = known(F.col(col).cast("double"))
    data = df.where(F.col(bucket).isNotNull() & x.isNotNull()).select(F.col(bucket), x.alias("_v"))
    if fused_quantiles(exact, sketch, method):
        met, (q,) = (own_percentiles(data, ["_v"], [QUARTILES], [bucket]) if exact
                     else (data, [quantiles(F.col("_v"), QUARTILES, accuracy=accuracy)]))
        box = met.groupBy(bucket).agg(q.alias("q"))
    elif exact:
        box = exact_box(data, "_v", [bucket], k)
    else:
        box = approx_quantiles(data, "_v", QUARTILES, by=[bucket], k=rel_err_to_k(1.0 / accuracy))
    more = [c for c in ("whisker_low", "whisker_high", "n_out", "n") if "n_out" in box.columns]
    box = box.select(bucket, F.get("q", 0).alias("q1"), F.get("q", 1).alias("median"),
                     F.get("q", 2).alias("q3"), *more)
    if more:
        return box
    iqr = F.col("q3") - F.col("q1")
    box = box.withColumns({"_lo": F.col("q1") - F.lit(k) * iqr,
                           "_hi": F.col("q3") + F.lit(k) * iqr})
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    box, rows = settled(box)
    out = (attach(data, box, [bucket], ["q1", "median", "q3", "_lo", "_hi"], rows)
               .groupBy(bucket, "q1", "median", "q3")
               .agg(F.min(F.when(v >= lo, v)).alias("_wl"),
                    F.max(F.when(v <= hi, v)).alias("_wh"),
                    F.count(F.when((v < lo) | (v > hi), F.lit(1))).alias("n_out"),
                    F.count(v).alias("n")))
    return out.select(
        bucket, "q1", "median", "q3",
        F.least(F.coalesce(F.col("_wl"), F.col("q1")), F.col("q1")).alias("whisker_low"),
        F.greatest(F.coalesce(F.col("_wh"), F.col("q3")), F.col("q3")).alias("whisker_high"),
        "n_out", "n")
