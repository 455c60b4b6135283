"""Table shape, per-column profile, eight-number summaries, centre.

Each operator is a single global ``agg`` (partial aggregate per task, one
small final merge), turned into long rows with ``inline`` afterwards.  The
aggregate-expression builders are shared with the report so that all of its
global statistics come from one scan.

Quantiles: ``exact=False`` (default) merges KLL sketches in two levels
(``approx_quantiles``) at every size; values may differ between runs within the
requested rank error.  ``sketch='gk'`` asks for Spark's ``percentile_approx``
inside the same single aggregate (repeatable, but its buffers are merged per
group in one task).  ``exact=True`` repeats: it interpolates like ``describe()``
and is computed by ``exact_quantiles`` (no task holds all values; its passes run
while the result is built), then joined to the moments as a one-row scalar
subquery.  NaN counts as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablestats.functions.clean import known
from tablestats.operators.filters import band
from tablestats.operators.quantiles import (
    approx_quantiles,
    exact_quantiles,
    fused_quantiles,
    own_percentiles,
    rel_err_to_k,
)

# Statistic names and order of the eight-number summary, the
# quartile levels, and the default sketch accuracy of the summary.
STAT_ORDER = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")
QUARTILES = (0.25, 0.5, 0.75)
SUMMARY_ACCURACY = 10000
MEDIAN_REL_ERROR = 0.01


def quantiles(x: Column, levels=QUARTILES, exact: bool = False,
              accuracy: int = SUMMARY_ACCURACY) -> Column:
    """Array of quantiles of ``x`` (nulls ignored)."""
    lv = F.array(*[F.lit(float(p)) for p in levels])
    if exact:
        return F.percentile(x, lv)
    return F.percentile_approx(x, lv, F.lit(accuracy))


def median(x: Column, exact: bool = False, rel_err: float = MEDIAN_REL_ERROR) -> Column:
    if exact:
        return F.median(x)
    return F.percentile_approx(x, F.lit(0.5), F.lit(int(round(1.0 / rel_err))))


def summary_struct(x: Column, exact: bool = False, accuracy: int = SUMMARY_ACCURACY,
                   mean_of: Column | None = None, with_quantiles: bool = True, q: Column | None = None) -> Column:
    """Aggregate expression: struct of the eight statistics of ``x``.

    ``q``: an aggregate that gives the quartiles (else built here).  ``mean_of`` replaces the input of the mean only (robust summary).  Null
    inputs are ignored, so a filtered summary is the same expression over
    ``when(cond, x)``.  ``with_quantiles=False`` leaves the three quartiles
    null, to be filled from ``exact_quantiles``.
    """
    if with_quantiles:
        q = quantiles(x, QUARTILES, exact, accuracy) if q is None else q
        q25, q50, q75 = (F.get(q, i).cast("double") for i in range(3))
    else:
        q25 = q50 = q75 = F.lit(None).cast("double")
    return F.struct(
        F.count(x).cast("double").alias("count"),
        F.avg(mean_of if mean_of is not None else x).alias("mean"),
        F.stddev_samp(x).alias("stddev"),
        F.min(x).cast("double").alias("min"),
        q25.alias("q25"),
        q50.alias("q50"),
        q75.alias("q75"),
        F.max(x).cast("double").alias("max"),
    )


def with_exact_quartiles(s: Column, q: Column) -> Column:
    """Fill the quartile fields of a summary struct from a quantile array."""
    return (s.withField("q25", F.get(q, 0)).withField("q50", F.get(q, 1))
             .withField("q75", F.get(q, 2)))


_FIELDS = ("count", "mean", "stddev", "min", "q25", "q50", "q75", "max")


def summary_rows(s: Column) -> Column:
    """Array of (stat, value) structs from a ``summary_struct`` column."""
    return F.array(*[
        F.struct(F.lit(name).alias("stat"), s.getField(field).alias("value"))
        for name, field in zip(STAT_ORDER, _FIELDS)
    ])


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols): row count and column count of a table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_cols"))


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: (ordinal, column, type, non_null), from one scan."""
    fields = df.schema.fields
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("type"),
                 F.col(f"c{i}").alias("non_null"))
        for i, f in enumerate(fields)
    ])))


def _summary(data: DataFrame, x: Column, exact: bool, accuracy: int,
             mean_of: Column | None = None, sketch: str | None = None,
             method: str | None = None) -> DataFrame:
    if fused_quantiles(exact, sketch, method):
        data, (q,) = own_percentiles(data, [x], [QUARTILES]) if exact else (data, (None,))
        one = data.agg(summary_struct(x, exact, accuracy, mean_of, q=q).alias("s"))
    else:
        qdf = (exact_quantiles(data, x, QUARTILES, method=method) if exact
               else approx_quantiles(data, x, QUARTILES, k=rel_err_to_k(1.0 / accuracy)))
        q = qdf.select("q").scalar()
        one = (data.agg(summary_struct(x, mean_of=mean_of, with_quantiles=False).alias("s"))
                   .select("s", q.alias("_q"))   # one reference to the subquery
                   .select(with_exact_quartiles(F.col("s"), F.col("_q")).alias("s")))
    return one.select(F.inline(summary_rows(F.col("s"))))


def summary(df: DataFrame, col: str, exact: bool = False, lo: float | None = None,
            hi: float | None = None, lo_open: bool = False, hi_open: bool = False,
            accuracy: int = SUMMARY_ACCURACY, sketch: str | None = None,
            method: str | None = None) -> DataFrame:
    """Eight-number summary as long rows (stat string, value double).

    count, mean, stddev (sample), min, 25%, 50%, 75%, max of the non-null
    values of ``col`` inside the optional band.
    """
    data = band(df, col, lo, hi, lo_open, hi_open) if (lo is not None or hi is not None) else df
    return _summary(data, known(F.col(col).cast("double")), exact, accuracy, sketch=sketch, method=method)


def robust_summary(df: DataFrame, col: str, mean_max: float = 1000.0, exact: bool = False,
                   accuracy: int = SUMMARY_ACCURACY, sketch: str | None = None,
                   method: str | None = None) -> DataFrame:
    """Summary over all rows, except the mean, taken over values <= mean_max.

    One pass with a conditional mean: the same result as joining a full and a
    filtered summary on the statistic name, without a second scan or a join.
    """
    x = known(F.col(col).cast("double"))
    return _summary(df, x, exact, accuracy, mean_of=F.when(x <= mean_max, x), sketch=sketch,
                    method=method)


def center(df: DataFrame, col: str, max_value: float | None = None, exact: bool = False,
           rel_err: float = MEDIAN_REL_ERROR, sketch: str | None = None,
           method: str | None = None) -> DataFrame:
    """(mean, median) of non-null ``col`` values, optionally only those <= max_value."""
    x = known(F.col(col).cast("double"))
    v = F.when(x <= max_value, x) if max_value is not None else x
    if fused_quantiles(exact, sketch, method):
        df, (q,) = own_percentiles(df, [v], [[0.5]]) if exact else (df, (None,))
        return df.agg(F.avg(v).alias("mean"), (F.get(q, 0) if exact else median(v, rel_err=rel_err)).alias("median"))
    # Count, mean and sketch come from one pass.
    got = (exact_quantiles(df, v, [0.5], method=method) if exact
           else approx_quantiles(df, v, [0.5], k=rel_err_to_k(rel_err)))
    return got.select("mean", F.get("q", 0).alias("median"))
