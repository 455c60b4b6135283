import datetime as dt

import pytest

from tablestats import (
    add_ratio, add_total, add_year, bucket, clean_numeric, clean_numeric_col, clean_table,
    corr_label, parse_date, select_existing, to_number,
)
from tablestats.functions import LENIENT_DATE_FORMATS

PRICES = ["9.99", "$9.99", "1,299.50", "Free", "0", "-3", ".", "1.2.3", "100", "100.01",
          "1000", "1000.01", "", None, "12.5%", "1e7"]


def col_values(df, c):
    return [r[c] for r in df.select(c).collect()]


def test_clean_numeric_col_strict(spark):
    df = spark.createDataFrame([(p,) for p in PRICES], "p string")
    got = col_values(df.select(clean_numeric_col("p").alias("v")), "v")
    assert got == [9.99, 9.99, 1299.5, None, 0.0, 3.0, None, None, 100.0, 100.01,
                   1000.0, 1000.01, None, None, 12.5, 17.0]


def test_to_number_coerce(spark):
    vals = ["9.99", "-3", "$9.99", "1,299.50", "Free", "12.5%", "1e7", "NaN", "Infinity", "5d",
            " 7 ", "", None, ".5", "-.5e1"]
    df = spark.createDataFrame([(v,) for v in vals], "p string")
    got = col_values(df.select(to_number("p").alias("v")), "v")
    assert got == [9.99, -3.0, None, None, None, None, 1e7, None, None, None, 7.0, None, None,
                   0.5, -5.0]


def test_parse_date_strict_and_lenient(spark):
    vals = ["2014-12-31", "2015-01-01", "2024-1-5", "Jan 5, 2024", "Coming soon", "2024-02-30",
            "2024-01-05 10:00:00", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    strict = col_values(df.select(parse_date("s").alias("d")), "d")
    assert strict == [dt.date(2014, 12, 31), dt.date(2015, 1, 1)] + [None] * 7
    lenient = col_values(df.select(parse_date("s", LENIENT_DATE_FORMATS).alias("d")), "d")
    assert lenient == [dt.date(2014, 12, 31), dt.date(2015, 1, 1), dt.date(2024, 1, 5),
                       dt.date(2024, 1, 5), None, None, dt.date(2024, 1, 5), None, None]


def test_bucket_right_closed_and_null(spark):
    df = spark.createDataFrame([(2014,), (2015,), (None,), (1990,), (2030,)], "y int")
    got = col_values(df.select(bucket("y", [2014], ["old", "new"]).alias("b")), "b")
    assert got == ["old", "new", None, "old", "new"]
    three = col_values(df.select(bucket("y", [2000, 2014], ["a", "b", "c"]).alias("b")), "b")
    assert three == ["b", "c", None, "a", "c"]
    with pytest.raises(ValueError):
        bucket("y", [1, 2], ["a"])


def test_select_existing(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "a int, b string, c double")
    assert select_existing(df, ["c", "zz", "a"]).columns == ["c", "a"]
    assert select_existing(df, ["zz"]).columns == []


def test_clean_numeric_types_and_reparse(spark):
    df = spark.createDataFrame([("Brand#17", -3.5, 4)], "s string, d double, i int")
    row = clean_numeric(df, ["s", "d", "i"]).first()
    assert (row.s, row.d, row.i) == (17.0, -3.5, 4.0)
    row = clean_numeric(df, ["d"], reparse=True).first()
    assert row.d == 3.5  # the strict rule drops the sign of text forms too


def test_total_and_ratio_guards(spark):
    df = spark.createDataFrame([(3, 1), (0, 0), (None, 5), (2, None), (0, 4)], "positive long, negative long")
    out = add_ratio(add_total(df)).collect()
    assert [r.total_reviews for r in out] == [4, 0, None, None, 4]
    assert [r.positive_ratio for r in out] == [75.0, None, None, None, 0.0]
    lean = spark.createDataFrame([(1,)], "positive long")
    assert add_total(lean, strict=False).columns == ["positive"]


def test_add_year(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 1),), (None,)], "d date")
    assert col_values(add_year(df, "d", "y"), "y") == [2024, None]


RAW_SCHEMA = ("name string, release_date string, price string, user_score string, "
              "metacritic_score string, positive long, negative long, pct_pos_total double, "
              "categories string, genres string, tags string, extra string")


def test_clean_table_raw_text(spark):
    rows = [
        ("A, b", "2014-12-31", "$9.99", "85", "77", 10, 5, 66.7, "c", "g", "t", "x"),
        (None, "2015-01-01", "Free", "12.5%", "tbd", 0, 0, 0.0, None, None, None, None),
        ('say "hi"', "Coming soon", "1,299.50", None, "0", None, 3, None, "c", "g", "t", "x"),
    ]
    df = spark.createDataFrame(rows, RAW_SCHEMA)
    out = clean_table(df)
    assert out.columns == ["name", "price", "user_score", "metacritic_score", "positive",
                           "negative", "pct_pos_total", "categories", "genres", "tags",
                           "release_date", "release_year", "total_reviews", "positive_ratio"]
    types = dict(out.dtypes)
    assert types["price"] == "double" and types["release_year"] == "int"
    assert types["total_reviews"] == "bigint" and types["release_date"] == "date"
    r = out.collect()
    assert r[0].price == 9.99 and r[0].release_year == 2014 and r[0].positive_ratio == 10 / 15 * 100
    assert r[1].price is None and r[1].user_score == 12.5 and r[1].metacritic_score is None
    assert r[1].total_reviews == 0 and r[1].positive_ratio is None
    assert r[2].release_date is None and r[2].total_reviews is None and r[2].price == 1299.5


def test_clean_table_spec_missing(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        clean_table(df, {"name": "a"})


def test_corr_label(spark):
    df = spark.createDataFrame([(0.9,), (0.7,), (0.5,), (0.3,), (-0.2,), (None,)], "r double")
    got = col_values(df.select(corr_label("r").alias("l")), "l")
    assert [g.split(":")[0] if g else g for g in got] == [
        "High positive correlation", "Moderate positive correlation",
        "Moderate positive correlation", "Low correlation", "Low correlation", None]


def test_clean_expressions_have_no_python(spark):
    df = spark.createDataFrame([(p,) for p in PRICES], "p string")
    plan = df.select(clean_numeric_col("p"), to_number("p"), parse_date("p")) \
             ._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
