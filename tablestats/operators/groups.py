"""Per-key counts and statistics, last-N keys, peak key, key span, series.

All grouped work is a ``groupBy().agg()``: a partial aggregate in every map
task, one shuffle of at most (#keys x #tasks) small rows, a final aggregate.
A hot key that holds a third of the rows therefore costs nothing extra: it is
reduced map-side before anything moves.  Ordering and last-N run on the
aggregated result only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablestats.functions.clean import known

# The per-year statistics of the catalogue analysis.
DEFAULT_MEANS = {
    "avg_price": "price",
    "avg_user_score": "user_score",
    "avg_metacritic": "metacritic_score",
    "avg_pct_pos": "pct_pos_total",
}
DEFAULT_KEY = "release_year"
DEFAULT_COUNT_COL = "name"
DEFAULT_COUNT_OUT = "game_count"
MIN_GROUP_ROWS = 30      # keep groups with more rows than this
LAST_COUNTS = 10         # latest keys shown for counts
LAST_STATS = 15          # latest keys shown for per-key statistics


def _count(count_col: str | None) -> Column:
    return F.count(F.col(count_col)) if count_col else F.count(F.lit(1))


def count_by(df: DataFrame, key: str = DEFAULT_KEY, count_col: str | None = DEFAULT_COUNT_COL,
             out: str = DEFAULT_COUNT_OUT, order: bool = True) -> DataFrame:
    """Rows with a non-null ``key``, counted per key.

    ``count_col`` counts its non-null values (default); ``None`` counts rows.
    """
    res = (df.where(F.col(key).isNotNull())
             .groupBy(key)
             .agg(_count(count_col).alias(out)))
    return res.orderBy(key) if order else res


def per_key(df: DataFrame, key: str = DEFAULT_KEY, count_col: str | None = DEFAULT_COUNT_COL,
            means: Mapping[str, str] = DEFAULT_MEANS, count_out: str = DEFAULT_COUNT_OUT) -> DataFrame:
    """One aggregate pass: count plus unrounded means per non-null key.

    Shared by ``group_stats`` and the report so counts and means come from a
    single scan and a single shuffle.
    """
    aggs = [_count(count_col).alias(count_out)]
    aggs += [F.avg(known(F.col(src).cast("double"))).alias(out) for out, src in means.items()]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def round_and_gate(stats: DataFrame, means: Mapping[str, str] = DEFAULT_MEANS,
                   digits: int | None = 2, min_count: int | None = MIN_GROUP_ROWS,
                   half_even: bool = False, count_out: str = DEFAULT_COUNT_OUT) -> DataFrame:
    """Round the mean columns and keep groups with more than ``min_count`` rows."""
    if digits is not None:
        rnd = F.bround if half_even else F.round
        stats = stats.withColumns({out: rnd(F.col(out), digits) for out in means})
    if min_count is not None:
        stats = stats.where(F.col(count_out) > min_count)
    return stats


def group_stats(df: DataFrame, key: str = DEFAULT_KEY, count_col: str | None = DEFAULT_COUNT_COL,
                means: Mapping[str, str] = DEFAULT_MEANS, digits: int | None = 2,
                min_count: int | None = MIN_GROUP_ROWS, half_even: bool = False,
                count_out: str = DEFAULT_COUNT_OUT, order: bool = True) -> DataFrame:
    """Per-key count and means, rounded (half-up, or half-even), HAVING count > min_count."""
    res = round_and_gate(per_key(df, key, count_col, means, count_out), means, digits,
                         min_count, half_even, count_out)
    return res.orderBy(key) if order else res


def last_n(df: DataFrame, key: str = DEFAULT_KEY, n: int = LAST_COUNTS) -> DataFrame:
    """The ``n`` largest keys, returned in ascending key order.

    Planned as ``TakeOrderedAndProject``: each task keeps its own top n, so
    only n rows per task reach the final merge.
    """
    return df.orderBy(F.col(key).desc_nulls_last()).limit(n).orderBy(F.col(key).asc_nulls_first())


def peak(counts: DataFrame, key: str = DEFAULT_KEY, n_col: str = DEFAULT_COUNT_OUT) -> DataFrame:
    """The key with the largest count; on ties the smallest key.  0 or 1 row."""
    return (counts.orderBy(F.coalesce(F.col(n_col), F.lit(0)).desc(), F.col(key).asc_nulls_last())
                  .limit(1)
                  .select(key, n_col))


def span(df: DataFrame, key: str = DEFAULT_KEY, first: str | None = None,
         last: str | None = None) -> DataFrame:
    """First and last value of ``key`` (one row; both null when no value exists)."""
    return df.agg(F.min(F.col(key)).alias(first or f"first_{key}"),
                  F.max(F.col(key)).alias(last or f"last_{key}"))


def series(stats: DataFrame, key: str = DEFAULT_KEY, val: str = "avg_price",
           n: int = LAST_STATS) -> DataFrame:
    """Chart series: the last ``n`` keys of a per-key table, null values dropped."""
    return last_n(stats, key, n).where(F.col(val).isNotNull()).select(key, val)
