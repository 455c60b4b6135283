import functools
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablestats import (box_stats, bucket_stats, corr_gated, fit_line, linear_fit, predict,
                        sample_n)
from tablestats.operators import spread
from tablestats.operators.relate import _threshold


def brute_box(values, k=1.5):
    v = np.sort(np.asarray(values, dtype=float))
    q1, med, q3 = np.percentile(v, [25, 50, 75])
    iqr = q3 - q1
    lo, hi = q1 - k * iqr, q3 + k * iqr
    inside_lo, inside_hi = v[v >= lo], v[v <= hi]
    wl = q1 if len(inside_lo) == 0 or inside_lo.min() > q1 else inside_lo.min()
    wh = q3 if len(inside_hi) == 0 or inside_hi.max() < q3 else inside_hi.max()
    n_out = int(((v < wl) | (v > wh)).sum())
    return q1, med, q3, wl, wh, n_out


@pytest.mark.parametrize("bound", [65536, 64])
def test_box_stats_matches_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(spread, "exact_box", functools.partial(spread.exact_box, bound=bound))
    rng = np.random.default_rng(3)
    data = {"a": list(rng.normal(10, 2, 400)) + [60.0, -40.0], "b": list(rng.exponential(5, 300)),
            "c": [7.0]}
    rows = [(b, float(x)) for b, xs in data.items() for x in xs] + [(None, 1.0), ("a", None)]
    df = spark.createDataFrame(rows, "b string, x double")
    got = {r.b: r for r in box_stats(df, "b", "x", exact=True).collect()}
    assert set(got) == {"a", "b", "c"}
    for b, xs in data.items():
        q1, med, q3, wl, wh, n_out = brute_box(xs)
        r = got[b]
        for ours, want in ((r.q1, q1), (r.median, med), (r.q3, q3), (r.whisker_low, wl),
                           (r.whisker_high, wh)):
            assert math.isclose(ours, want, rel_tol=1e-12, abs_tol=1e-12)
        assert r.n_out == n_out and r.n == len(xs)


def test_box_stats_spreads_hot_buckets(spark):
    df = spark.range(5000).selectExpr("if(id % 10 < 9, 'hot', 'b') as b", "cast(id as double) as x")
    out = box_stats(df, "b", "x", exact=True)
    assert "Statistics" not in out._jdf.queryExecution().optimizedPlan().toString()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in plan  # the counted state of two buckets is broadcast, no raw row is dealt out
    assert {r.b: r.n for r in out.collect()} == {"hot": 4500, "b": 500}


@pytest.mark.parametrize("values", [
    [0.0] * 3 + [1.0] * 5 + [9.0] * 2, [float(i) for i in range(40)] + [1e6, 1e6, -1e6], [3.0], [1.0, 2.0], [5.0] * 50,
    [float("-inf"), 1.0, 2.0, 3.0, float("inf")], [1.0, 1.0, 1.0, 7.0]])
def test_whiskers_from_the_scans_of_the_quartiles(spark, values):
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 2.0 * i) for i in range(9)], "b string, x double")
    own = {r.b: r for r in box_stats(df, "b", "x", exact=True).collect()}
    by_name = {r.b: r for r in box_stats(df, "b", "x", exact=True, method="percentile").collect()}
    for b in ("a", "b"):
        assert [repr(v) for v in own[b]] == [repr(v) for v in by_name[b]]


def test_exact_box_takes_three_scans(spark):
    from tablestats.operators import quantiles
    df = spark.range(3000).selectExpr("id % 3 as b", "cast(id * id as double) as x")
    got = quantiles.exact_box(df, "x", ["b"], 1.5)
    assert {"whisker_low", "whisker_high", "n_out"} <= set(got.columns)
    # A box from 10 to 14 whose lower fence, 4, is the value of 200 rows.
    tied = spark.range(1400).selectExpr("0 as b", "cast(CASE WHEN id < 200 THEN 4 WHEN id < 800 THEN 10 ELSE 14 END as double) as x")
    assert "n_out" not in quantiles.exact_box(tied, "x", ["b"], 1.5, bound=64).columns


def test_bucket_stats(spark):
    rows = [("old", 1.0), ("old", 3.0), ("old", 10.0), ("new", 4.0), ("new", None), (None, 5.0)]
    df = spark.createDataFrame(rows, "era string, price double")
    got = {r.era: (r.n, r.mean, r.median) for r in bucket_stats(df, "era", "price", exact=True).collect()}
    assert got == {"old": (3, 14 / 3, 3.0), "new": (1, 4.0, 4.0)}


PAIRS = [(1.0, 2.0), (2.0, 4.1), (3.0, None), (4.0, 8.2)]


def test_corr_and_fit_fixture(spark):
    df = spark.createDataFrame(PAIRS, "x double, y double")
    c = corr_gated(df, "x", "y", min_rows=0).first()
    assert c.n == 3 and math.isclose(c.corr, 0.9999820, abs_tol=1e-7)
    assert corr_gated(df, "x", "y").first().corr is None  # 3 pairs is not more than 10
    f = linear_fit(df, "x", "y", min_rows=1).first()
    assert math.isclose(f.slope, 2.0642857, abs_tol=1e-7)
    assert math.isclose(f.intercept, -0.05, abs_tol=1e-9) and f.n == 3
    zx, zy = np.array([1, 2, 4.0]), np.array([2, 4.1, 8.2])
    np.testing.assert_allclose(np.polyfit(zx, zy, 1), [f.slope, f.intercept], rtol=1e-12)


def test_corr_constant_and_single_row(spark):
    const = spark.createDataFrame([(1.0, float(i)) for i in range(20)], "x double, y double")
    assert corr_gated(const, "x", "y").first().corr is None
    assert linear_fit(const, "x", "y").first().slope is None
    assert fit_line(const, "x", "y").count() == 0
    one = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert linear_fit(one, "x", "y").first().slope is None


def test_corr_null_is_not_zero(spark):
    rows = [(float(i), float(2 * i + (i % 3))) for i in range(30)] + [(None, 5.0), (7.0, None)]
    df = spark.createDataFrame(rows, "x double, y double")
    x = np.array([r[0] for r in rows[:30]]); y = np.array([r[1] for r in rows[:30]])
    assert math.isclose(corr_gated(df, "x", "y").first().corr, np.corrcoef(x, y)[0, 1], rel_tol=1e-12)


def test_fit_line_matches_linspace(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 100, 200); y = 3 * x + rng.normal(0, 5, 200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    pts = fit_line(df, "x", "y").orderBy("i").collect()
    z = np.polyfit(x, y, 1)
    xs = np.linspace(x.min(), x.max(), 100)
    assert [p.i for p in pts] == list(range(100))
    np.testing.assert_allclose([p.x for p in pts], xs, rtol=1e-12)
    np.testing.assert_allclose([p.y for p in pts], np.poly1d(z)(xs), rtol=1e-9)
    assert pts[-1].x == x.max()


def test_predict_uses_scalar_fit(spark):
    df = spark.createDataFrame(PAIRS, "x double, y double")
    fit = linear_fit(df, "x", "y", min_rows=1)
    out = predict(df, fit, "x", "yhat")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    f = fit.first()
    for r in out.collect():
        assert math.isclose(r.yhat, f.slope * r.x + f.intercept, rel_tol=1e-12)


def test_sample_n_repeatable(spark):
    df = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    a = [tuple(r) for r in sample_n(df, "k", 100).collect()]
    b = [tuple(r) for r in sample_n(df.repartition(5), "k", 100).collect()]
    assert len(a) == 100 and sorted(a) == sorted(b)
    assert sample_n(df, "k", 5000).count() == 2000
    plan = sample_n(df, "k", 100)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def _naive_sample(df, key, n):
    rest = [c for c in df.columns if c != key]
    others = F.md5(F.concat_ws("\u001f", *[F.col(c).cast("string") for c in rest]))
    order = [F.md5(F.col(key).cast("string")), F.col(key), others, *[F.col(c) for c in rest]]
    return [tuple(r) for r in df.orderBy(*order).limit(n).collect()]


@pytest.mark.parametrize("n", [1, 7, 300, 5000])
def test_sample_n_equals_naive_top_n_with_hot_key(spark, n):
    base = spark.range(3000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
    hot = spark.range(1500).select(F.lit(17).cast("long").alias("k"), F.col("id").alias("v"))
    df = base.unionByName(hot)
    got = [tuple(r) for r in sample_n(df, "k", n).collect()]
    assert sorted(got) == sorted(_naive_sample(df, "k", n))
    plan = sample_n(df, "k", n)._jdf.queryExecution().executedPlan().toString()
    assert ("Filter" in plan) == (n < 4500)  # only the smallest-hash rows reach the top-n merge


def test_sample_n_empty(spark):
    df = spark.range(0).select(F.col("id").alias("k"))
    assert sample_n(df, "k", 10).count() == 0


def test_corr_equals_stat_corr_on_pairs(spark):
    """On non-null pairs the gated correlation equals DataFrame.stat.corr."""
    import os

    from conftest import SF01
    li = spark.read.parquet(os.path.join(SF01, "lineitem.parquet"))
    want = li.select("l_quantity", "l_extendedprice").dropna().stat.corr("l_quantity", "l_extendedprice")
    got = corr_gated(li, "l_quantity", "l_extendedprice").first().corr
    assert math.isclose(got, want, rel_tol=1e-12)


def test_sample_of_a_mostly_null_key_stays_small(spark):
    """90 % of the rows share one key value: only about n of them enter the top-n."""
    df = spark.range(40000).selectExpr("if(id % 10 = 0, cast(id as string), null) as k", "id").repartition(4)
    rows = [(r.k, r.id) for r in df.collect()]

    def order(r):
        return (hashlib.md5((r[0] or "").encode()).hexdigest(), r[0] is None, r[0] or "",
                hashlib.md5(str(r[1]).encode()).hexdigest(), r[1])

    for n in (1, 50, 3000, 36010, 50000):
        got = sample_n(df, "k", n)
        assert [tuple(r) for r in got.collect()] == sorted(rows, key=order)[:n]
    top = _threshold(df, F.md5(F.coalesce("k", F.lit(""))), 50000, 10)
    assert top is None
    few = sample_n(df, "k", 3000)
    entering = few._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in entering and "Filter" in entering
    hashes = sorted(order(r)[0] for r in rows)
    null = hashlib.md5(b"").hexdigest()
    below = sum(h < null for h in hashes)
    bound, left, tied = _threshold(df, F.md5(F.coalesce("k", F.lit(""))), below + 100, 1600)
    assert (bound, left, tied) == (null, 100, True)
    second, _, _ = _threshold(df.where("k is null"), F.md5(F.col("id").cast("string")), 100, 1600)
    assert 100 <= df.where("k is null").where(F.md5(F.col("id").cast("string")) <= second).count() <= 1700


def test_sample_of_equal_rows(spark):
    df = spark.createDataFrame([(1, "a")] * 300 + [(2, "b")] * 5, "k int, v string")
    got = [tuple(r) for r in sample_n(df, "k", 4).collect()]
    want = sorted([(1, "a")] * 300 + [(2, "b")] * 5, key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest())[:4]
    assert got == want and sample_n(df, "k", 0).count() == 0
