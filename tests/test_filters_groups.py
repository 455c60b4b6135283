from pyspark.sql import functions as F

from tablestats import band, count_by, drop_nulls, group_stats, last_n, peak, series, span


def test_band_variants(spark):
    df = spark.createDataFrame([(v, l) for v, l in [(-1.0, "a"), (0.0, "a"), (50.0, None),
                                                     (100.0, "b"), (100.5, "b"), (None, "a")]],
                               "x double, l string")
    assert sorted(r.x for r in band(df, "x", 0, 100).collect()) == [0.0, 50.0, 100.0]
    assert sorted(r.x for r in band(df, "x", lo=0, lo_open=True).collect()) == [50.0, 100.0, 100.5]
    assert sorted(r.x for r in band(df, "x", hi=100, hi_open=True).collect()) == [-1.0, 0.0, 50.0]
    assert sorted(r.x for r in band(df, "x", 0, 100, label="l").collect()) == [0.0, 100.0]
    assert band(df, "x").count() == 5


def test_drop_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    assert [tuple(r) for r in drop_nulls(df, ["a", "b"]).collect()] == [(3, 4)]
    assert drop_nulls(df, ["a"]).count() == 2


def _years(spark, sizes, named=True):
    rows = []
    for y, n in sizes.items():
        rows += [(y, f"g{i}" if named or i % 2 else None, float(i), 1.0, 2.0, 3.0) for i in range(n)]
    return spark.createDataFrame(rows, "release_year int, name string, price double, "
                                       "user_score double, metacritic_score double, pct_pos_total double")


def test_group_stats_threshold_30_31(spark):
    df = _years(spark, {2000: 30, 2001: 31, 2002: 45})
    got = {r.release_year: r.game_count for r in group_stats(df).collect()}
    assert got == {2001: 31, 2002: 45}
    out = group_stats(df).collect()
    assert [r.release_year for r in out] == [2001, 2002]  # ordered
    assert out[0].avg_price == 15.0


def test_group_stats_rounding_modes(spark):
    df = spark.createDataFrame([(1, "n", 0.125, 0.0, 0.0, 0.0)],
                               "release_year int, name string, price double, user_score double, "
                               "metacritic_score double, pct_pos_total double")
    assert group_stats(df, min_count=0).first().avg_price == 0.13
    assert group_stats(df, min_count=0, half_even=True).first().avg_price == 0.12


def test_count_by_name_vs_rows(spark):
    df = _years(spark, {2000: 4}, named=False).union(
        spark.createDataFrame([(None, "x", 1.0, 1.0, 1.0, 1.0)], _years(spark, {1: 1}).schema))
    assert [tuple(r) for r in count_by(df).collect()] == [(2000, 2)]
    assert [tuple(r) for r in count_by(df, count_col=None, out="n").collect()] == [(2000, 4)]


def test_last_n_fewer_keys_and_order(spark):
    df = spark.createDataFrame([(y, y * 10) for y in [2003, 2001, 2002]], "release_year int, game_count long")
    assert [r.release_year for r in last_n(df, n=10).collect()] == [2001, 2002, 2003]
    assert [r.release_year for r in last_n(df, n=2).collect()] == [2002, 2003]
    plan = last_n(df, n=2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_peak_ties_smallest_key(spark):
    df = spark.createDataFrame([(2001, 5), (1999, 7), (2005, 7), (2000, None)],
                               "release_year int, game_count long")
    assert tuple(peak(df).first()) == (1999, 7)
    empty = df.where(F.lit(False))
    assert peak(empty).count() == 0


def test_span_and_empty(spark):
    df = spark.createDataFrame([(2001,), (None,), (1995,)], "release_year int")
    assert tuple(span(df).first()) == (1995, 2001)
    assert tuple(span(df.where(F.col("release_year").isNull())).first()) == (None, None)


def test_series_drops_null_values(spark):
    df = spark.createDataFrame([(y, None if y == 2002 else float(y)) for y in range(1990, 2010)],
                               "release_year int, avg_price double")
    got = [r.release_year for r in series(df, n=15).collect()]
    assert got == [y for y in range(1995, 2010) if y != 2002]
