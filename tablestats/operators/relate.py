"""Relations between two columns: gated correlation, straight-line fit,
prediction, plot-ready fit line, repeatable sample.

Moments are global aggregates (partial per task, one small merge).  The fit
is used by later expressions through scalar subqueries, which Spark runs once
and inlines as constants: no join, no cross product, no driver round trip in
user code.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Minimum number of pairs for a correlation, points on a fit
# line, rows in a scatter sample.
MIN_PAIRS = 10
LINE_POINTS = 100
SAMPLE_ROWS = 5000


def _pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rows with a number on both sides (NaN is none)."""
    cond = F.col(x).isNotNull() & F.col(y).isNotNull()
    for c in (x, y):
        if dict(df.dtypes).get(c) in ("double", "float"):
            cond = cond & ~F.isnan(F.col(c))
    return df.where(cond)


def corr_gated(df: DataFrame, x: str, y: str, min_rows: int = MIN_PAIRS) -> DataFrame:
    """(n, corr): Pearson correlation over non-null pairs, only when n > min_rows.

    Null-safe: rows where either side is null are dropped (not read as 0),
    and a constant column gives null instead of a division error.
    """
    xc, yc = F.col(x).cast("double"), F.col(y).cast("double")
    raw = _pairs(df, x, y).agg(
        F.count(F.lit(1)).alias("n"),
        F.try_divide(F.covar_pop(xc, yc), F.stddev_pop(xc) * F.stddev_pop(yc)).alias("_r"))
    return raw.select("n", F.when(F.col("n") > min_rows, F.col("_r")).alias("corr"))


def linear_fit(df: DataFrame, x: str, y: str, min_rows: int = MIN_PAIRS) -> DataFrame:
    """(slope, intercept, n): least-squares line y = slope * x + intercept.

    Over non-null pairs; null unless n > min_rows and x is not constant.
    """
    xc, yc = F.col(x).cast("double"), F.col(y).cast("double")
    raw = _pairs(df, x, y).agg(F.regr_slope(yc, xc).alias("_s"),
                               F.regr_intercept(yc, xc).alias("_i"),
                               F.count(F.lit(1)).alias("n"))
    ok = F.col("n") > min_rows
    return raw.select(F.when(ok, F.col("_s")).alias("slope"),
                      F.when(ok, F.col("_i")).alias("intercept"), "n")


def predict(df: DataFrame, fit: DataFrame, x: str, out: str = "fitted",
            slope: str = "slope", intercept: str = "intercept") -> DataFrame:
    """Add ``out = slope * x + intercept`` from a one-row fit table."""
    line = fit.select(F.struct(F.col(slope).alias("s"), F.col(intercept).alias("i"))).scalar()
    with_fit = df.select("*", line.alias("_fit"))  # one reference to the subquery
    return with_fit.select(*df.columns, (F.col("_fit.s") * F.col(x).cast("double")
                                         + F.col("_fit.i")).alias(out))


def fit_line(df: DataFrame, x: str, y: str, n: int = LINE_POINTS,
             min_rows: int = MIN_PAIRS) -> DataFrame:
    """``n`` evenly spaced points (i, x, y) over [min x, max x] on the fitted line.

    Zero rows when no line can be fitted.  The points are generated from the
    one-row fit by ``explode(sequence)``; the last point is exactly max x.
    """
    xc, yc = F.col(x).cast("double"), F.col(y).cast("double")
    fit = _pairs(df, x, y).agg(F.regr_slope(yc, xc).alias("slope"),
                               F.regr_intercept(yc, xc).alias("intercept"),
                               F.count(F.lit(1)).alias("n"),
                               F.min(xc).alias("lo"), F.max(xc).alias("hi"))
    pts = (fit.where(F.col("slope").isNotNull() & (F.col("n") > min_rows))
              .select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"),
                      "slope", "intercept", "lo", "hi"))
    step = (F.col("hi") - F.col("lo")) / F.lit(float(max(n - 1, 1)))
    px = F.when(F.col("i") == n - 1, F.col("hi")).otherwise(F.col("i") * step + F.col("lo"))
    return (pts.withColumn("x", px)
               .select("i", "x", (F.col("slope") * F.col("x") + F.col("intercept")).alias("y")))


#: Hex digits that one counting pass of a threshold tells apart, and candidates per row wanted.
_DIGITS = 3
_SPARE = 16


def _threshold(rows: DataFrame, text: Column, n: int, enough: int) -> tuple[str, int, bool] | None:
    """The upper end of a range of hash texts that holds the n smallest, ``enough`` rows more at most.

    Also how many of the n lie at that end's own bin, and whether that bin is one text
    with more rows than ``enough``.  None if there are n rows at most.  Each pass counts
    the next hex digits (4,096 groups at most) of the bin in which the n-th lies.
    """
    bins, prefix = rows.select(text.alias("_t")), ""
    while True:
        digits = F.substring("_t", len(prefix) + 1, _DIGITS)
        counted = (bins.where(F.col("_t").startswith(prefix)).groupBy(digits.alias("_d"))
                   .agg(F.count(F.lit(1)).alias("c"), F.min("_t").alias("lo"), F.max("_t").alias("hi")).orderBy("_d").collect())
        if not prefix and sum(r.c for r in counted) <= n:
            return None
        for r in counted:
            if r.c >= n:
                break
            n -= r.c
        if r.c <= enough or r.lo == r.hi:
            return r.hi, n, r.c > enough
        prefix = os.path.commonprefix([r.lo, r.hi])


def sample_n(df: DataFrame, key_cols: Sequence[str] | str, n: int = SAMPLE_ROWS) -> DataFrame:
    """Up to ``n`` rows, chosen by the md5 of the key: the same rows every run.

    The result is exactly ``orderBy(md5(key), key, md5(other columns), other
    columns).limit(n)`` (a null key as the empty text, so the chosen multiset is fully
    determined), computed without sending n rows from every task to one final merge:

    1. counting passes over the hash's leading hex digits find an upper bound that
       the n smallest hashes lie below, with at most 16 n rows;
    2. if one key alone holds more rows than that (a null or coarse key), the same passes
       over the hash of the other columns find a bound among the rows of this key;
    3. only rows within the bounds enter the top-n (``TakeOrderedAndProject``).

    The passes run while the sample is built; each brings 4,096 counts to the driver at most.
    """
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    rest = [c for c in df.columns if c not in keys]
    if n <= 0:
        return df.limit(0)
    texts = [F.col(k).cast("string") for k in keys]
    # A null key hashes as the empty text (concat_ws leaves nulls out).
    h = F.md5(F.coalesce(texts[0], F.lit(""))) if len(texts) == 1 else F.md5(F.concat_ws("\u001f", *texts))
    others = F.md5(F.concat_ws("\u001f", *[F.col(c).cast("string") for c in rest]))
    found = _threshold(df, h, n, _SPARE * n)
    kept = df
    if found is not None:
        top, left, tied = found
        within = h < top if tied else h <= top
        if tied:
            second = _threshold(df.where(h == top), others, left, _SPARE * n)
            within = within | ((h == top) & (others <= second[0] if second else F.lit(True)))
        kept = df.where(within)
    order = [h, *[F.col(k).asc_nulls_last() for k in keys], others, *[F.col(c).asc_nulls_last() for c in rest]]
    hidden = [f"_o{i}" for i in range(2)]
    ranked = kept.withColumns({hidden[0]: h, hidden[1]: others})
    order[0], order[1 + len(keys)] = F.col(hidden[0]), F.col(hidden[1])
    return ranked.orderBy(*order).limit(n).select(*df.columns)
