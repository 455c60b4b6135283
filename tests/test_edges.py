"""FIXTURES edge cases: empty frames, all-null columns, gate boundaries."""

import pytest
from pyspark.sql import functions as F

from tablestats import (band, box_stats, bucket_stats, center, clean_table, column_profile,
                        corr_gated, count_by, drop_nulls, fit_line, group_stats, last_n,
                        linear_fit, peak, predict, report_lines, robust_summary, sample_n,
                        series, shape, span, summary, summary_lines)

CLEAN_SCHEMA = ("name string, price double, user_score double, metacritic_score double, "
                "positive long, negative long, pct_pos_total double, categories string, "
                "genres string, tags string, release_date date, release_year int, "
                "total_reviews long, positive_ratio double")


@pytest.fixture(params=["empty", "all_null"])
def frame(request, spark):
    if request.param == "empty":
        return spark.createDataFrame([], CLEAN_SCHEMA)
    row = tuple([None] * 14)
    return spark.createDataFrame([row, row], CLEAN_SCHEMA)


def operators(df):
    era = df.withColumn("era", F.lit("old"))
    fit = linear_fit(df, "metacritic_score", "user_score")
    return {
        "band": band(df, "price", 0, 100, label="name"),
        "drop_nulls": drop_nulls(df, ["price"]),
        "count_by": count_by(df),
        "group_stats": group_stats(df, min_count=0),
        "last_n": last_n(count_by(df, order=False), n=10),
        "peak": peak(count_by(df, order=False)),
        "span": span(df),
        "series": series(group_stats(df, min_count=0, order=False)),
        "shape": shape(df),
        "column_profile": column_profile(df),
        "summary": summary(df, "price"),
        "summary_exact": summary(df, "price", exact=True),
        "robust": robust_summary(df, "price", exact=True),
        "center": center(df, "price", max_value=1000),
        "center_exact": center(df, "price", max_value=1000, exact=True),
        "bucket_stats": bucket_stats(era, "era", "price"),
        "bucket_stats_exact": bucket_stats(era, "era", "price", exact=True),
        "box": box_stats(era, "era", "price"),
        "box_exact": box_stats(era, "era", "price", exact=True),
        "corr": corr_gated(df, "metacritic_score", "user_score"),
        "fit": fit,
        "predict": predict(df, fit, "metacritic_score"),
        "fit_line": fit_line(df, "metacritic_score", "user_score"),
        "sample": sample_n(df, ["name", "tags"], 10),
        "summary_lines": summary_lines(summary(df, "price")),
        "report": report_lines(df),
        "report_exact": report_lines(df, exact=True, digits=2),
    }


def test_every_operator_survives(frame):
    results = {name: df.collect() for name, df in operators(frame).items()}
    assert results["shape"][0].n_rows in (0, 2)
    assert {r.stat: r.value for r in results["summary"]}["count"] == 0
    assert {r.stat: r.value for r in results["summary_exact"]}["50%"] is None
    assert results["center_exact"][0].median is None
    assert results["corr"][0].corr is None and results["fit"][0].slope is None
    assert results["fit_line"] == [] and results["box"] == [] and results["box_exact"] == []
    assert results["peak"] == [] and results["last_n"] == []
    lines = [r.line for r in results["report_exact"]]
    assert "mean: None" in lines and any(t.startswith("Total number of games") for t in lines)


def _pairs(spark, n):
    return spark.createDataFrame([(float(i), float(2 * i + i % 3)) for i in range(n)],
                                 "x double, y double")


def test_corr_gate_10_and_11(spark):
    assert corr_gated(_pairs(spark, 10), "x", "y").first().corr is None
    assert corr_gated(_pairs(spark, 11), "x", "y").first().corr is not None


def test_group_threshold_exact_boundary_via_clean_table(spark):
    rows = [(f"g{i}", "$1.00", "1", "1", 1, 1, 1.0, "c", "g", "t", "2020-01-01") for i in range(31)]
    rows += [(f"h{i}", "$2.00", "1", "1", 1, 1, 1.0, "c", "g", "t", "2021-06-01") for i in range(30)]
    raw = spark.createDataFrame(rows, "name string, price string, user_score string, "
                                "metacritic_score string, positive long, negative long, "
                                "pct_pos_total double, categories string, genres string, "
                                "tags string, release_date string")
    got = [tuple(r)[:3] for r in group_stats(clean_table(raw)).collect()]
    assert got == [(2020, 31, 1.0)]


def test_price_cut_boundaries(spark):
    raw = spark.createDataFrame([(p,) for p in ["100", "100.01", "1000", "1000.01", "0", "-3"]],
                                "price string")
    from tablestats import clean_numeric
    df = clean_numeric(raw, ["price"])
    assert sorted(r.price for r in band(df, "price", 0, 100).collect()) == [0.0, 3.0, 100.0]
    got = {r.stat: r.value for r in robust_summary(df, "price", mean_max=1000, exact=True).collect()}
    assert got["mean"] == (100 + 100.01 + 1000 + 0 + 3) / 5 and got["max"] == 1000.01
    c = center(df, "price", max_value=1000, exact=True).first()
    assert c.median == 100.0
