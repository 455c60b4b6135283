"""End-to-end analysis job: raw table -> cleaned Parquet/CSV -> report -> request."""

import json
import os

from conftest import SF001
from tablestats import read_table
from tablestats.plans.bindings import lineitem_spec, table
from tablestats.plans.job import analyze


def test_analyze_writes_every_output(spark, tmp_out):
    out = analyze(spark, tmp_out, raw=table(spark, SF001, "lineitem"), spec=lineitem_spec())
    cleaned = read_table(spark, out["cleaned"])
    assert cleaned.count() == table(spark, SF001, "lineitem").count()
    assert len(cleaned.columns) == 14
    assert read_table(spark, os.path.join(tmp_out, "cleaned_csv"), fmt="csv").count() == cleaned.count()
    parts = [p for p in os.listdir(out["report"]) if p.startswith("part-")]
    assert len(parts) == 1
    with open(os.path.join(out["report"], parts[0]), encoding="utf-8") as fh:
        text = fh.read().splitlines()
    assert text[0].startswith("DATASET ANALYSIS RESULTS") and "5. KEY INSIGHTS (based on Spark analysis)" in text
    reqs = spark.read.json(out["request"]).collect()
    assert len(reqs) == 1
    body = json.loads(reqs[0].request)
    assert body["messages"][0]["content"].endswith("\n".join(text) + "\n")
    assert out["total_sec"] >= out["calc_sec"] > 0


def test_analyze_from_csv_converts_once(spark, tmp_out):
    src = os.path.join(tmp_out, "src")
    os.makedirs(src)
    from test_io import write_csv
    write_csv(src, "games")
    out = analyze(spark, os.path.join(tmp_out, "out"), base=src, name="games")
    assert os.path.isdir(os.path.join(src, "games.parquet"))
    assert read_table(spark, out["cleaned"]).count() == 3


def test_command_line(spark, tmp_out):
    from tablestats.__main__ import main
    from test_io import write_csv
    src = os.path.join(tmp_out, "src")
    os.makedirs(src)
    write_csv(src, "games")
    res = main(["--base", src, "--name", "games", "--out", os.path.join(tmp_out, "o1"), "--exact",
                "--csv-single"], spark=spark)
    assert read_table(spark, res["cleaned"]).count() == 3
    maps = ["name=nullif(l_returnflag, 'A')", "price=l_extendedprice", "user_score=l_quantity",
            "metacritic_score=round(l_discount * 100)", "positive=round(l_discount * 100)",
            "negative=round(l_tax * 100)", "pct_pos_total=l_linenumber", "categories=l_linestatus",
            "genres=l_returnflag", "tags=cast(l_suppkey as string)", "release_date=l_shipdate"]
    args = ["--input", os.path.join(SF001, "lineitem.parquet"), "--out", os.path.join(tmp_out, "o2"),
            "--no-csv"]
    for m in maps:
        args += ["--map", m]
    res = main(args, spark=spark)
    assert not os.path.exists(os.path.join(tmp_out, "o2", "cleaned_csv"))
    want = read_table(spark, analyze(spark, os.path.join(tmp_out, "o3"),
                                     raw=table(spark, SF001, "lineitem"),
                                     spec=lineitem_spec())["report_lines"]).collect()
    assert sorted(read_table(spark, res["report_lines"]).collect()) == sorted(want)


def test_chart_tables(spark, tmp_out):
    out = analyze(spark, tmp_out, raw=table(spark, SF001, "lineitem"), spec=lineitem_spec(),
                  write_csv=False, exact=True)
    series = read_table(spark, out["price_series"]).collect()
    assert 0 < len(series) <= 15
    sample = read_table(spark, out["scatter_sample"])
    assert sample.columns == ["metacritic_score", "user_score"] and sample.count() == 5000
    line = read_table(spark, out["scatter_line"]).orderBy("i").collect()
    assert [r.i for r in line] == list(range(100))
    # lineitem prices all exceed 100, so the era box has no rows: no buckets
    assert read_table(spark, out["era_box"]).count() == 0
    assert read_table(spark, out["era_stats"]).count() == 0


def test_chart_tables_eras(spark):
    import numpy as np

    from tablestats.plans.job import chart_tables
    from tablestats import clean_table
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        year = 2010 + i % 10
        rows.append((f"g{i}", f"${rng.uniform(0, 120):.2f}", str(rng.integers(1, 100)),
                     str(rng.integers(1, 100)), 5, 1, 80.0, "c", "g", "t", f"{year}-06-01"))
    raw = spark.createDataFrame(rows, "name string, price string, user_score string, "
                                "metacritic_score string, positive long, negative long, "
                                "pct_pos_total double, categories string, genres string, "
                                "tags string, release_date string")
    clean = clean_table(raw)
    t = chart_tables(clean, exact=True)
    box = {r.era: r for r in t["era_box"].collect()}
    stats = {r.era: r for r in t["era_stats"].collect()}
    assert set(box) == {"old", "new"} == set(stats)
    for era, years in (("old", range(2010, 2015)), ("new", range(2015, 2020))):
        prices = [float(r[1][1:]) for r in rows if int(r[10][:4]) in years and float(r[1][1:]) <= 100]
        assert stats[era].n == len(prices) and box[era].n == len(prices)
        assert abs(stats[era].median - float(np.median(prices))) < 1e-9
        assert abs(box[era].q1 - float(np.percentile(prices, 25))) < 1e-9
    assert t["scatter_sample"].count() == 400 and t["scatter_line"].count() == 100
    assert t["price_series"].count() == 10  # 40 rows per year: every year has more than 30
