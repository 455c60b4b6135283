import numpy as np
import pytest
from pyspark.sql import functions as F

from tablestats.operators import quantiles
from tablestats.operators.quantiles import exact_quantiles

LEVELS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def brute(values):
    return list(np.percentile(np.asarray(values, dtype=float), [p * 100 for p in LEVELS]))


@pytest.mark.parametrize("n", [1, 2, 3, 10, 101, 5000])
def test_exact_matches_numpy_small_and_mid(spark, n):
    rng = np.random.default_rng(n)
    vals = rng.normal(0, 100, n)
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "v double")
    row = exact_quantiles(df, "v", LEVELS).first()
    assert row.n == n
    np.testing.assert_allclose(row.q, brute(vals), rtol=1e-12, atol=1e-12)


def test_exact_groups_hot_value_and_ties(spark):
    # group 0: a third of all rows share one value; group 1: heavy ties; group 2: one row
    rows = [(0, 5.0)] * 30000 + [(0, float(v)) for v in range(30000)]
    rows += [(1, float(v % 7)) for v in range(20000)] + [(2, 42.0)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: r for r in exact_quantiles(df, "v", LEVELS, by=["g"]).collect()}
    for g in (0, 1, 2):
        vals = [v for k, v in rows if k == g]
        assert got[g].n == len(vals)
        np.testing.assert_allclose(got[g].q, brute(vals), rtol=1e-12)


@pytest.mark.parametrize("k,bound", [(64, 100), (16, 65536), (200, 1)])
def test_exact_many_distinct_uses_brackets(spark, k, bound):
    # small sketches and bounds: wide brackets, so the counted narrowing does the work
    df = spark.range(300000).select((F.rand(5) * 1e6).alias("v")).repartition(7)
    vals = [r.v for r in df.collect()]
    row = exact_quantiles(df, "v", LEVELS, k=k, bound=bound, method="bracket").first()
    np.testing.assert_allclose(row.q, brute(vals), rtol=1e-12)


def test_exact_empty_input(spark):
    df = spark.createDataFrame([(None,)], "v double")
    row = exact_quantiles(df, "v", [0.5]).first()
    assert row.n == 0 and row.q is None
    assert exact_quantiles(df.withColumn("g", F.lit(1)), "v", [0.5], by=["g"]).count() == 0


def test_exact_plan_is_distributed(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"), (F.col("id") % 3).alias("g"))
    plan = exact_quantiles(df, "v", [0.5], by=["g"], method="bracket")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "percentile(" not in plan.replace("percentile_approx", "")
    assert "PythonUDF" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("salted,bound", [(True, 65536), (False, 10), (True, 10)])
def test_exact_paths_agree(spark, salted, bound):
    df = spark.range(20000).select((F.col("id") % 13).alias("g"), (F.rand(2) * 50).alias("v")).repartition(5)
    vals = {}
    for r in df.collect():
        vals.setdefault(r.g, []).append(r.v)
    got = {r.g: r.q for r in exact_quantiles(df, "v", LEVELS, by=["g"], salted=salted, method="bracket",
                                                bound=bound, k=32).collect()}
    for g, vs in vals.items():
        np.testing.assert_allclose(got[g], brute(vs), rtol=1e-12)


def test_kll_sketch_paths_close_to_exact(spark):
    from tablestats import box_stats, center, report_lines, summary
    from tablestats.operators.quantiles import approx_quantiles
    rng = np.random.default_rng(11)
    vals = rng.normal(100, 30, 20000)
    df = spark.createDataFrame([(float(v), "ab"[i % 2]) for i, v in enumerate(vals)], "v double, b string")
    srt = np.sort(vals)

    def rank_ok(x, p, tol=0.01):
        r = np.searchsorted(srt, x) / len(srt)
        return abs(r - p) <= tol

    row = approx_quantiles(df, "v", [0.1, 0.5, 0.9]).first()
    assert row.n == 20000 and all(rank_ok(x, p) for x, p in zip(row.q, [0.1, 0.5, 0.9]))
    for salted in (True, False):
        q = approx_quantiles(df, "v", [0.5], by=["b"], salted=salted).collect()
        assert len(q) == 2
    s = {r.stat: r.value for r in summary(df, "v", sketch="kll").collect()}
    assert s["count"] == 20000 and rank_ok(s["25%"], 0.25) and rank_ok(s["75%"], 0.75)
    # center's sketch follows rel_err=0.01 (k about 270): allow three times that
    assert rank_ok(center(df, "v", sketch="kll").first().median, 0.5, tol=0.03)
    assert {r.b for r in box_stats(df, "b", "v", sketch="kll").collect()} == {"a", "b"}
    with pytest.raises(ValueError):
        summary(df, "v", sketch="tdigest")


def test_report_kll_matches_gk_layout(spark):
    from tablestats.plans.bindings import catalog
    from tablestats import report_lines
    from conftest import SF001
    clean = catalog(spark, SF001)
    a = report_lines(clean, sketch="gk").orderBy("section", "seq").collect()
    b = report_lines(clean, sketch="kll").orderBy("section", "seq").collect()
    assert [(r.section, r.seq) for r in a] == [(r.section, r.seq) for r in b]
    same = [x.line == y.line for x, y in zip(a, b)]
    assert sum(same) >= len(a) - 10  # only sketch quartile/median lines may differ


def test_one_path_at_every_size(spark):
    df = spark.range(5000).select((F.col("id") % 4).alias("g"), (F.rand(9) * 10).alias("v"))
    own = exact_quantiles(df, "v", LEVELS, by=["g"])  # small, and yet the same path
    assert "percentile(" not in own._jdf.queryExecution().executedPlan().toString()
    a = {r.g: r.q for r in own.collect()}
    b = {r.g: r.q for r in exact_quantiles(df, "v", LEVELS, by=["g"], method="percentile").collect()}
    for g in a:
        np.testing.assert_allclose(a[g], b[g], rtol=1e-13)
    with pytest.raises(ValueError):
        exact_quantiles(df, "v", [0.5], method="sorted")


def test_accuracy_is_kept_or_refused():
    from tablestats.operators.quantiles import MAX_K, kll_rank_error, rel_err_to_k
    assert kll_rank_error(rel_err_to_k(1e-4)) <= 1e-4 and rel_err_to_k(1e-4) <= MAX_K
    with pytest.raises(ValueError):
        rel_err_to_k(1e-6)


def test_extreme_values(spark):
    vals = [float("-inf"), -1e308, -1.0, 0.0, 5e-324, 1.0, 1e308, float("inf")] * 50
    df = spark.createDataFrame([(v,) for v in vals] + [(float("nan"),), (None,)], "v double")
    row = exact_quantiles(df, "v", [0.2, 0.45, 0.8]).first()
    srt = sorted(vals)
    assert row.n == 400 and row.q[0] == srt[80] and row.q[2] == srt[320]


@pytest.mark.parametrize("method", ["percentile", "bracket"])
def test_null_group_keys_are_ignored(spark, method):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (None, 100.0), (None, 200.0), (2, None)],
                               "g int, v double")
    got = {r.g: (r.n, r.q) for r in exact_quantiles(df, "v", [0.5], by=["g"], method=method).collect()}
    assert got == {1: (2, [2.0])}
    from tablestats.operators.quantiles import approx_quantiles
    assert [r.g for r in approx_quantiles(df, "v", [0.5], by=["g"]).collect()] == [1]


def shapes():
    rng = np.random.default_rng(7)
    return {
        "lognormal": rng.lognormal(0, 12, 60000),
        "clustered": np.concatenate([1 + 1e-12 * rng.random(40000), 1e9 + rng.random(20000), [-1e300, 1e300]]),
        "tied": np.concatenate([np.full(40000, 5.0), 5 + 1e-14 * np.arange(300), rng.normal(5, 1e-6, 3000)]),
        "few values": rng.integers(0, 4, 30000).astype(float),
    }


@pytest.mark.parametrize("shape", list(shapes()))
def test_no_task_ranks_more_values_than_the_bound(spark, monkeypatch, shape):
    vals, bound, states = shapes()[shape], 64, []
    whole = quantiles.settled

    def watched(df):
        out, rows = whole(df)
        states.append(rows)
        return out, rows

    monkeypatch.setattr(quantiles, "settled", watched)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double").repartition(6)
    levels = [0.001, 0.25, 0.5, 0.75]
    got = exact_quantiles(df, "v", levels, k=64, bound=bound).first()
    np.testing.assert_allclose(got.q, np.percentile(vals, [p * 100 for p in levels]), rtol=1e-12)
    last = states[-1][0]
    assert all(last[f"_c{4 * t + 2}"] <= bound for t in range(len(levels)) if last[f"_need{t}"])
    assert got.n == len(vals) and len(states) >= 3


def test_a_missed_bracket_is_mended(spark, monkeypatch):
    vals = np.random.default_rng(2).normal(0, 1, 20000)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double").repartition(6)
    whole, calls = quantiles.settled, []

    def misled(df):
        out, rows = whole(df)
        calls.append(1)
        if len(calls) == 1:  # the first brackets lie beside their ranks
            rows[0] |= {"_lo0": 0.5, "_hi0": 0.6, "_lo1": -2.0, "_hi1": -1.9}
            return df.sparkSession.createDataFrame([tuple(rows[0].values())], df.schema), rows
        return out, rows

    monkeypatch.setattr(quantiles, "settled", misled)
    got = exact_quantiles(df, "v", [0.25, 0.75], bound=500).first()
    np.testing.assert_allclose(got.q, np.percentile(vals, [25, 75]), rtol=1e-12)


def grouped(spark):
    rng = np.random.default_rng(4)
    rows = [("hot", float(v)) for v in rng.exponential(9, 6000)] + [(f"g{i % 30}", float(i % 97)) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "g string, v double").repartition(5)


def test_many_groups_go_through_a_checkpoint_and_salted_joins(spark, monkeypatch):
    rows, df = grouped(spark)
    monkeypatch.setattr(quantiles, "LOCAL_GROUPS", 4)
    monkeypatch.setattr(quantiles, "ROWS_PER_COPY", 500)
    got = {r.g: r.q for r in exact_quantiles(df, "v", LEVELS, by=["g"], k=64, bound=100).collect()}
    assert len(got) == 31
    for g, q in got.items():
        np.testing.assert_allclose(q, brute([v for k, v in rows if k == g]), rtol=1e-12)


def test_few_groups_shuffle_no_raw_rows(spark):
    _, df = grouped(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = exact_quantiles(df, "v", [0.5], by=["g"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "_salt" not in plan and "BroadcastHashJoin" in plan
    lines = plan.splitlines()
    dealt = [(line, lines[i + 1]) for i, line in enumerate(lines) if "Exchange hashpartitioning(" in line]
    assert dealt and all("Aggregate" in below or "Window" in below for _, below in dealt), dealt  # only counts are dealt out


def test_several_series_share_their_scans(spark):
    df = spark.range(4000).select(F.col("id").cast("double").alias("a"), (F.rand(3) * 9).alias("b"))
    rows = df.collect()
    r = quantiles.exact_series(df, ["a", F.when(F.col("b") > 4, F.col("b")), F.lit(None)], [[0.5], [0.25, 0.5], [0.5]], k=64, bound=50).first()
    assert (r.n0, r.q0) == (4000, [1999.5]) and r.n2 == 0 and r.q2 is None
    big = [x.b for x in rows if x.b > 4]
    np.testing.assert_allclose(r.q1, np.percentile(big, [25, 50]), rtol=1e-12)
    assert r.n1 == len(big)
    assert abs(r.mean1 - np.mean(big)) < 1e-9


@pytest.mark.parametrize("by_name", ["center", "summary", "bucket", "box", "quantiles"])
def test_a_percentile_asked_for_by_name_merges_few_values(spark, monkeypatch, by_name):
    from tablestats.operators.profile import center, summary
    from tablestats.operators.spread import box_stats, bucket_stats
    n = 200_000
    df = spark.range(n, numPartitions=4).selectExpr("cast(id * id as double) as v", "0 as g")
    run = {"center": lambda: [center(df, "v", exact=True, method="percentile").first().median],
           "summary": lambda: [r.value for r in summary(df, "v", exact=True, method="percentile").collect() if "%" in r.stat],
           "bucket": lambda: [bucket_stats(df, "g", "v", exact=True, method="percentile").first().median],
           "box": lambda: list(box_stats(df, "g", "v", exact=True, method="percentile").first()[1:4]),
           "quantiles": lambda: list(exact_quantiles(df, "v", LEVELS, by=["g"], method="percentile").first().q)}[by_name]
    levels = {"center": [0.5], "bucket": [0.5], "quantiles": LEVELS}.get(by_name, [0.25, 0.5, 0.75])
    want = np.percentile(np.arange(n, dtype=float) ** 2, [p * 100 for p in levels])
    np.testing.assert_allclose(run(), want, rtol=1e-13)

    def distinct(x, p):
        one = F.count_distinct(x).cast("double")
        return one if isinstance(p._jc.toString(), str) and "array" not in p._jc.toString() else F.array(*[one] * len(levels))

    monkeypatch.setattr(F, "percentile", distinct)
    monkeypatch.setattr(F, "median", lambda x: distinct(x, F.lit(0.5)))
    assert max(run()) <= quantiles.BOUND + 2


def test_a_percentile_asked_for_by_name_on_ties_and_few_rows(spark):
    rows = [("a", v) for v in [1.0] * 50 + [2.0] * 50] + [("b", 7.0), ("c", None), (None, 3.0), ("d", float("nan"))]
    df = spark.createDataFrame(rows + [("e", float("-inf")), ("e", 0.0), ("e", float("inf"))], "g string, v double")
    got = {r.g: (r.n, r.q) for r in exact_quantiles(df, "v", [0.0, 0.5, 1.0], by=["g"], method="percentile").collect()}
    assert got == {"a": (100, [1.0, 1.5, 2.0]), "b": (1, [7.0] * 3), "e": (3, [float("-inf"), 0.0, float("inf")])}
    none = exact_quantiles(df.where("g = 'c'"), "v", [0.5], method="percentile").first()
    assert none.n == 0 and none.q is None
    # No rank strictly inside, and more values there than the bound.
    wide = spark.range(1, 300).selectExpr("explode(array_repeat(CASE WHEN id = 1 THEN 0D ELSE cast(id as double) END, CASE WHEN id = 1 THEN 400 ELSE 1 END)) as v")
    met, (q,) = quantiles.own_percentiles(wide, ["v"], [[0.5]], k=64, bound=64)
    assert met.agg(q.alias("q")).first().q == [0.0]
