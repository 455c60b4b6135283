"""Plan checks over every registered query, and the DuckDB oracle at sf0.01."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF01

sys.path.insert(0, os.path.join(ROOT, "scripts"))
import __spark_entry__ as se  # noqa: E402
from oracle_check import TABLES, digest, type_mismatches  # noqa: E402

from tablestats.plans.bindings import QUERIES  # noqa: E402

NAMES = sorted(QUERIES)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["release_year", "game_count"]


def test_every_query_has_oracle_or_reason():
    assert not set(QUERIES) - set(se.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_no_python_no_cartesian(spark, name):
    plan = plan_of(se.queries()[name](spark, SF01))
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in plan, bad


def test_filters_reach_parquet(spark):
    plan = plan_of(se.queries()["band_price"](spark, SF01))
    assert "PushedFilters: [IsNotNull(l_extendedprice), LessThanOrEqual(l_extendedprice,50000.0)]" in plan


def test_scans_are_pruned(spark):
    plan = plan_of(se.queries()["corr_gated"](spark, SF01))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double>" in plan


def _scans(df):
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    return final.split("Initial Plan")[0].count("FileScan parquet")


def test_report_scans(spark):
    from tablestats.plans.bindings import catalog
    from tablestats.plans.report import report_lines
    clean = catalog(spark, SF01)
    assert _scans(report_lines(clean, sketch="gk")) <= 2  # the table once, per key once
    assert _scans(report_lines(clean)) <= 2               # sketches come from the same scan
    # The statistics and counts of the exact report are taken while it is built.
    assert _scans(report_lines(clean, exact=True)) <= 2   # per key, and the values inside the brackets


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF01, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(set(se.oracle_sql()) & set(QUERIES)))
def test_oracle_match(spark, duck, name):
    df = se.queries()[name](spark, SF01)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(se.oracle_sql()[name])
    assert not type_mismatches(df.dtypes, rel.columns, rel.types)
    res = duck.execute(se.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_band_on_cleaned_catalog_reaches_parquet(spark):
    from tablestats import band
    from tablestats.plans.bindings import catalog
    plan = plan_of(band(catalog(spark, SF01, finite=False), "price", hi=1000.0).select("price"))
    assert "LessThanOrEqual(l_extendedprice,1000.0)" in plan
    assert "ReadSchema: struct<l_extendedprice:double>" in plan
    # A column that can hold NaN is read whole, and alone; whole numbers are never wrapped.
    guarded = plan_of(band(catalog(spark, SF01), "price", hi=1000.0).select("price"))
    assert "ReadSchema: struct<l_extendedprice:double>" in guarded
    whole = plan_of(band(catalog(spark, SF01), "pct_pos_total", hi=3.0).select("pct_pos_total"))
    assert "Infinity" not in whole
