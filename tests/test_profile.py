import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tablestats import center, column_profile, robust_summary, shape, summary
from tablestats.operators.profile import STAT_ORDER


def as_dict(df):
    return {r.stat: r.value for r in df.collect()}


@pytest.fixture
def one_to_ten(spark):
    return spark.createDataFrame([(float(v),) for v in range(1, 11)], "x double")


def test_summary_exact_and_sketch_quartiles(one_to_ten):
    exact = as_dict(summary(one_to_ten, "x", exact=True))
    assert (exact["25%"], exact["50%"], exact["75%"]) == (3.25, 5.5, 7.75)
    sketch = as_dict(summary(one_to_ten, "x"))
    assert (sketch["25%"], sketch["50%"], sketch["75%"]) == (3.0, 5.0, 8.0)
    assert exact["count"] == 10 and exact["min"] == 1 and exact["max"] == 10 and exact["mean"] == 5.5
    assert math.isclose(exact["stddev"], np.std(np.arange(1, 11), ddof=1))
    assert [r.stat for r in summary(one_to_ten, "x").collect()] == list(STAT_ORDER)


def test_summary_matches_pandas_describe(spark):
    rng = np.random.default_rng(7)
    vals = rng.normal(50, 20, 501).round(3)
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "x double")
    got = as_dict(summary(df, "x", exact=True))
    want = pd.Series(vals).describe()
    for ours, theirs in zip(STAT_ORDER, ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]):
        assert math.isclose(got[ours], want[theirs], rel_tol=1e-9), ours


def test_summary_empty_and_all_null(spark):
    empty = spark.createDataFrame([], "x double")
    got = as_dict(summary(empty, "x"))
    assert got["count"] == 0 and all(got[s] is None for s in STAT_ORDER[1:])
    nulls = spark.createDataFrame([(None,), (None,)], "x double")
    got = as_dict(summary(nulls, "x", exact=True))
    assert got["count"] == 0 and got["mean"] is None


def test_summary_band_positive_only(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (80.0,), (90.0,), (None,)], "x double")
    got = as_dict(summary(df, "x", lo=0, lo_open=True, exact=True))
    assert got["count"] == 2 and got["mean"] == 85.0 and got["min"] == 80.0


def test_robust_summary_mean_only_is_capped(spark):
    df = spark.createDataFrame([(10.0,), (20.0,), (5000.0,), (None,)], "x double")
    got = as_dict(robust_summary(df, "x", mean_max=1000, exact=True))
    assert got["mean"] == 15.0 and got["max"] == 5000.0 and got["count"] == 3
    plan = robust_summary(df, "x", sketch="gk")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") <= 1  # one pass over the input


def test_center_exact_and_capped(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 2000]], "x double")
    r = center(df, "x", exact=True).first()
    assert (r.mean, r.median) == (402.0, 3.0)
    r = center(df, "x", max_value=1000, exact=True).first()
    assert (r.mean, r.median) == (2.5, 2.5)
    empty = center(df.where("x > 1e9"), "x").first()
    assert (empty.mean, empty.median) == (None, None)


def test_sketch_rank_error_bound(spark):
    """Approximate quartiles lie within the sketch's rank-error bound (brute force)."""
    ev = spark.read.parquet(os.path.join(SF01, "events.parquet"))
    vals = np.sort(np.array([r.value for r in ev.select("value").collect()]))
    n = len(vals)
    got = as_dict(summary(ev, "value"))
    for stat, p in (("25%", 0.25), ("50%", 0.5), ("75%", 0.75)):
        lo_rank = np.searchsorted(vals, got[stat], side="left")
        hi_rank = np.searchsorted(vals, got[stat], side="right")
        target = p * n
        slack = n / 10000 + 1
        assert lo_rank - slack <= target <= hi_rank + slack, stat


def test_shape_and_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, "y")], "a int, b string")
    assert tuple(shape(df).first()) == (3, 2)
    prof = [tuple(r) for r in column_profile(df).collect()]
    assert prof == [(0, "a", "int", 2), (1, "b", "string", 2)]
    assert tuple(shape(df.where(F.lit(False))).first()) == (0, 2)


@pytest.mark.parametrize("table,col", [("events", "value"), ("lineitem", "l_extendedprice"),
                                       ("lineitem", "l_quantity")])
def test_sketch_summary_equals_spark_summary(spark, table, col):
    """The default sketch reproduces DataFrame.summary() value for value."""
    df = spark.read.parquet(os.path.join(SF01, f"{table}.parquet"))
    ref = {r["summary"]: float(r[col]) for r in df.select(col).summary().collect()}
    ours = as_dict(summary(df, col, sketch="gk"))
    for stat in STAT_ORDER:
        assert math.isclose(ours[stat], ref[stat], rel_tol=1e-12), stat


def test_sketch_median_equals_approx_quantile(spark):
    df = spark.read.parquet(os.path.join(SF01, "lineitem.parquet"))
    capped = df.where("l_extendedprice <= 50000")
    want = capped.approxQuantile("l_extendedprice", [0.5], 0.01)[0]
    got = center(df, "l_extendedprice", max_value=50000, sketch="gk").first().median
    assert got == want
