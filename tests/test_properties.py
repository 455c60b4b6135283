"""Property tests: Spark cleaning expressions against plain-Python statements
of the same rules, on random messy text (one Spark job per example batch)."""

import math
import re

from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st

from tablestats import clean_numeric_col, to_number

ALPHABET = "0123456789.,-+$%eE abc#"
texts = st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=12)), min_size=1,
                 max_size=300)


def finite(s):
    """The number, or None where it is beyond doubles."""
    return x if math.isfinite(x := float(s)) else None


def strict_rule(s):
    if s is None:
        return None
    kept = re.sub(r"[^0-9.]", "", s)
    if not re.fullmatch(r"[0-9]*\.?[0-9]*", kept) or kept in ("", "."):
        return None
    return finite(kept)


def coerce_rule(s):
    if s is None or not re.fullmatch(r"\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*", s):
        return None
    return finite(s)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts)
@example(["1E310", "-1e309", "9" * 400, "1e-400", "1e308"])
def test_clean_numeric_matches_rule(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r.i: r.v for r in df.select("i", clean_numeric_col("s").alias("v")).collect()}
    assert [got[i] for i in range(len(values))] == [strict_rule(v) for v in values]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts)
@example(["1E310", "-1e309", "9" * 400, "1e-400", "1e308"])
def test_to_number_matches_rule(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r.i: r.v for r in df.select("i", to_number("s").alias("v")).collect()}
    assert [got[i] for i in range(len(values))] == [coerce_rule(v) for v in values]


values_by_group = st.lists(
    st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-50, 50).map(float),
                                           st.floats(-1e6, 1e6, allow_nan=False))),
    min_size=1, max_size=400)
levels = st.lists(st.floats(0.0, 1.0, allow_nan=False), min_size=1, max_size=4)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values_by_group, levels)
def test_exact_quantiles_match_numpy(spark, rows, lv):
    import numpy as np

    from tablestats import exact_quantiles
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r.g: r.q for r in exact_quantiles(df, "v", lv, by=["g"], k=16, method="bracket").collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, vs in groups.items():
        np.testing.assert_allclose(got[g], np.percentile(vs, [p * 100 for p in lv]),
                                   rtol=1e-9, atol=1e-9)
