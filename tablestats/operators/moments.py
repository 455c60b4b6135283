"""Moments as small states that merge: one struct per part of the data, any number of parts.

``exact_series`` and ``approx_series`` salt the map tasks and merge their sketches in
two levels.  A series' count, mean, deviation and ends, or two series'
correlation, ride along as one struct per salt (``SALTS`` at most), gathered into
an array and merged here around the common mean, as Spark merges its own partial
states, and with as many digits.  So a report's statistics and sketches take one scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def moments(x: Column) -> Column:
    """Aggregate: the state of one part."""
    return F.struct(F.count(x).alias("n"), F.sum(x).alias("total"), F.avg(x).alias("mean"), F.var_pop(x).alias("var"),
                    F.min(x).alias("least"), F.max(x).alias("most"))


def pair_moments(x: Column, y: Column) -> Column:
    """Aggregate: the state of the rows in which both are known."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return F.struct(F.count(a).alias("n"), F.sum(a).alias("total"), F.sum(b).alias("other_total"), F.avg(a).alias("mean"), F.avg(b).alias("other_mean"),
                    F.var_pop(a).alias("var"), F.var_pop(b).alias("other_var"), F.covar_pop(a, b).alias("cov"))


def _sum(states: Column, term) -> Column:
    return F.aggregate(states, F.lit(0.0), lambda a, s: a + F.coalesce(term(s).cast("double"), F.lit(0.0)))


def count_of(states: Column) -> Column:
    return F.aggregate(states, F.lit(0).cast("long"), lambda a, s: a + s["n"])


def mean_of(states: Column, total: str = "total") -> Column:
    return F.try_divide(_sum(states, lambda s: s[total]), count_of(states).cast("double"))


def _spread(states: Column, n: Column, left: tuple[str, Column], right: tuple[str, Column], own: str) -> Column:
    """Sum over all rows of the product of both distances from the means."""
    return _sum(states, lambda s: s["n"] * (s[own] + (s[left[0]] - left[1]) * (s[right[0]] - right[1])))


def merged_moments(states: Column) -> Column:
    """Struct of ``count``, ``mean``, ``stddev`` (sample), ``min``, ``max``."""
    n, mean = count_of(states), mean_of(states)
    square = _spread(states, n, ("mean", mean), ("mean", mean), "var")
    return F.struct(n.cast("double").alias("count"), mean.alias("mean"),
                    F.when(n > 1, F.sqrt(square / (n - 1))).alias("stddev"),
                    F.array_min(F.transform(states, lambda s: s["least"])).cast("double").alias("min"),
                    F.array_max(F.transform(states, lambda s: s["most"])).cast("double").alias("max"))


def merged_correlation(states: Column) -> Column:
    """Pearson correlation; null without spread."""
    n, x, y = count_of(states), mean_of(states), mean_of(states, "other_total")
    cov = _spread(states, n, ("mean", x), ("other_mean", y), "cov")
    var_x = _spread(states, n, ("mean", x), ("mean", x), "var")
    var_y = _spread(states, n, ("other_mean", y), ("other_mean", y), "other_var")
    return F.try_divide(cov, F.sqrt(var_x) * F.sqrt(var_y))
