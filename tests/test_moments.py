"""Merged moments against Spark's own aggregates."""

import math

import pytest
from pyspark.sql import functions as F

from tablestats.operators.moments import count_of, merged_correlation, merged_moments, moments, pair_moments
from tablestats.operators.quantiles import approx_series, exact_series

CASES = {
    "plain": [(float(i % 17), float(i % 5) + 0.25 * i) for i in range(300)],
    "large offset": [(1e9 + i % 3, 1e12 - i % 7) for i in range(200)],
    "nulls": [(None, 1.0), (2.0, None), (3.0, 4.0), (5.0, 1.0), (None, None)],
    "constant": [(2.0, float(i)) for i in range(9)],
    "one": [(1.0, 2.0)],
    "empty": [],
}


@pytest.mark.parametrize("case", list(CASES))
def test_merged_states(spark, case):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(CASES[case])], "i int, x double, y double").repartition(6, "i")
    x, y = F.col("x"), F.col("y")
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    want = df.agg(F.count("x").cast("double").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("stddev"), F.min("x").alias("min"),
                  F.max("x").alias("max"), F.count(a).alias("n"),
                  F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)).alias("r")).first()
    states = [moments(x), pair_moments(x, y), F.struct(F.count(F.lit(1)).alias("n"))]
    for one in (approx_series(df, ["x"], [[0.5]], 64, states), exact_series(df, ["x"], [[0.5]], k=64, states=states)):
        got = one.select(F.col("q0"), merged_moments(F.col("s0")).alias("m"), count_of(F.col("s1")).alias("n"),
                         merged_correlation(F.col("s1")).alias("r"), count_of(F.col("s2")).alias("rows")).first()
        assert got.rows == len(CASES[case]) and got.n == want.n
        for name in ("count", "mean", "stddev", "min", "max"):
            left, right = got.m[name], want[name]
            assert (left is None) == (right is None) and (left is None or math.isclose(left, right, rel_tol=1e-7 if name == "stddev" else 1e-12, abs_tol=1e-12)), name
        assert (got.r is None) == (want.r is None) and (got.r is None or math.isclose(got.r, want.r, rel_tol=1e-9, abs_tol=1e-5 if case == "large offset" else 1e-12))
        assert (got.q0 is None) == (want["count"] == 0)
