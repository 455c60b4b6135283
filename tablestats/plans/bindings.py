"""Bindings of the operators to the driver's test tables.

``lineitem`` plays the catalogue table: name = l_returnflag with 'A' made
null, price = l_extendedprice, release date = l_shipdate, user score =
l_quantity, critic score = round(l_discount * 100) (zero on some rows),
positive = round(l_discount * 100), negative = round(l_tax * 100),
pct_pos_total = l_linenumber.  Other tables cover text cleaning (``part``,
``customer``, ``events``), box numbers and sampling (``events``), a second
per-year binding (``orders``) and prompts and chat payloads
(``conversations``).

Each ``q_*`` function takes (spark, sf_dir) and returns a DataFrame over the
whole input tables; ``ORACLE_SQL`` holds the equivalent DuckDB SQL.  Float
aggregates are rounded (4 places, 6 for correlations) on both sides so that
last-digit differences between engines do not count.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablestats.functions.clean import finite_number
from tablestats.functions import LENIENT_DATE_FORMATS, bucket, corr_label, parse_date, to_number
from tablestats.operators import (
    add_ratio,
    approx_quantiles,
    exact_quantiles,
    add_total,
    add_year,
    band,
    box_stats,
    bucket_stats,
    center,
    clean_numeric,
    clean_table,
    column_profile,
    corr_gated,
    count_by,
    drop_nulls,
    fit_line,
    group_stats,
    last_n,
    linear_fit,
    peak,
    predict,
    robust_summary,
    sample_n,
    select_existing,
    series,
    shape,
    span,
    summary,
)
from tablestats.operators.quantiles import SKETCH_K, attach, kll_rank_error
from tablestats.plans.chat import DEFAULT_INSTRUCTIONS, chat_content, chat_requests
from tablestats.plans.report import prompt_text, report_lines, summary_lines
from tablestats.session import ensure_checkpoint_dir
from tablestats.sources.io import (
    read_lines,
    read_or_convert,
    read_table,
    split_rejects,
    write_answers,
    write_report,
    write_table,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def lineitem_spec() -> dict:
    critic = F.round(F.col("l_discount") * 100)
    return {
        "name": F.expr("nullif(l_returnflag, 'A')"),
        "price": "l_extendedprice",
        "user_score": "l_quantity",
        "metacritic_score": critic,
        "positive": critic.cast("long"),
        "negative": F.round(F.col("l_tax") * 100).cast("long"),
        "pct_pos_total": "l_linenumber",
        "categories": "l_linestatus",
        "genres": "l_returnflag",
        "tags": F.col("l_suppkey").cast("string"),
        "release_date": "l_shipdate",
    }


def catalog(spark: SparkSession, sf_dir: str, finite: bool = True) -> DataFrame:
    """The cleaned 14-column catalogue view of ``lineitem``."""
    return clean_table(table(spark, sf_dir, "lineitem"), lineitem_spec(), finite=finite)


def _r(c: str, digits: int = 4):
    return F.round(F.col(c), digits).alias(c)


# --------------------------------------------------------------- projections

def q_select_existing(spark, sf):
    return select_existing(table(spark, sf, "part"), ["p_partkey", "p_brand", "p_color", "p_size"])


def q_clean_numeric_part(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return clean_numeric(part, ["p_brand", "p_type", "p_size"])


def q_clean_numeric_events(spark, sf):
    return clean_numeric(table(spark, sf, "events").select("event_id", "props"), ["props"])


def q_clean_numeric_customer(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return clean_numeric(cust, ["c_mktsegment", "c_acctbal"], reparse=True)


def q_to_number(spark, sf):
    cust = table(spark, sf, "customer")
    return cust.select("c_custkey",
                       to_number(F.col("c_mktsegment")).alias("segment_num"),
                       to_number(F.col("c_acctbal").cast("string")).alias("acctbal_num"),
                       to_number(F.col("c_name")).alias("name_num"))


def _event_date_text() -> F.Column:
    ts = F.col("ts")
    return (F.when(F.col("event_type") == "click", F.date_format(ts, "MMM d, yyyy"))
             .when(F.col("event_type") == "error", F.lit("Coming soon"))
             .when(F.col("event_type") == "signup", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
             .otherwise(F.date_format(ts, "yyyy-MM-dd")))


def q_parse_date(spark, sf):
    ev = table(spark, sf, "events").select("event_id", _event_date_text().alias("date_text"))
    return ev.withColumn("release_date", parse_date(F.col("date_text")))


def q_parse_date_lenient(spark, sf):
    ev = table(spark, sf, "events").select("event_id", _event_date_text().alias("date_text"))
    return ev.withColumn("release_date", parse_date(F.col("date_text"), LENIENT_DATE_FORMATS))


def q_parse_date_formats(spark, sf):
    """Each event's day written in one of the ten lenient formats, and parsed."""
    ev = table(spark, sf, "events")
    texts = F.array(*[F.date_format("ts", f) for f in LENIENT_DATE_FORMATS])
    text = F.get(texts, F.pmod(F.col("event_id"), F.lit(len(LENIENT_DATE_FORMATS))).cast("int"))
    return ev.select("event_id", text.alias("date_text")).withColumn(
        "release_date", parse_date(F.col("date_text"), LENIENT_DATE_FORMATS))


def q_clean_hostile(spark, sf):
    """Numbers beyond doubles and longs, as text made from the customer key, and numeric
    columns with NaN and infinities: null, never an error."""
    key = F.col("c_custkey")
    kind = F.pmod(key, F.lit(3))
    text = F.when(kind == 0, key.cast("string")).when(kind == 1, F.lit("1e999")).otherwise(F.repeat(F.lit("9"), 400))
    number = F.when(kind == 0, F.col("c_acctbal")).when(kind == 1, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    raw = table(spark, sf, "customer").select("c_custkey", text.alias("t"), F.when(kind == 1, F.lit("$1.0"))
                                              .otherwise(text).alias("s"), number.alias("x"))
    cleaned = clean_table(raw, {
        "name": key.cast("string"), "price": "x", "user_score": "t", "metacritic_score": "t", "positive": "t",
        "negative": F.lit("1"), "pct_pos_total": "x", "categories": "t", "genres": "s",
        "tags": F.lit(""), "release_date": F.lit("2020-01-01")})
    passed = clean_numeric(cleaned.withColumn("passed", -F.lit(float("inf")) * F.when(F.col("price").isNull(), 1.0)), ["genres"])
    return passed.select(F.col("name").cast("long").alias("c_custkey"), to_number("categories").alias("number"),
                         F.col("genres").alias("stripped"), "positive", "total_reviews", "price", "pct_pos_total",
                         F.coalesce(finite_number("passed"), "price").alias("passed"))


def _scratch(spark, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{ensure_checkpoint_dir(spark)}/tables-{uuid.uuid4().hex}/{name}"


def q_sink_roundtrip_parquet(spark, sf):
    path = _scratch(spark, "customer.parquet")
    write_table(table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), path)
    return read_table(spark, path)


def _messy(spark, sf) -> DataFrame:
    """Text with commas, quotes, line breaks and backslashes, and nulls."""
    note = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"\n\\ end'))
    return table(spark, sf, "customer").select("c_custkey", "c_acctbal", F.when(F.col("c_mktsegment") != "BUILDING", note).alias("note"))


def q_sink_roundtrip_csv(spark, sf):
    path = _scratch(spark, "customer_csv")
    write_table(_messy(spark, sf), path, fmt="csv")
    return read_table(spark, path, schema="c_custkey long, c_acctbal double, note string", fmt="csv")


def q_convert_roundtrip(spark, sf):
    """A CSV converted to its Parquet copy, which the second call reads."""
    base = _scratch(spark, "base")
    write_table(_messy(spark, sf), f"{base}/t.csv", fmt="csv")
    read_or_convert(spark, base, "t", schema="c_custkey long, c_acctbal double, note string")
    return read_or_convert(spark, base, "t")


def q_sink_roundtrip_report(spark, sf):
    """Ordered text in four parts, read back: each line with its position."""
    path = _scratch(spark, "lines")
    lines = table(spark, sf, "customer").select("c_mktsegment", "c_custkey", F.concat("c_mktsegment", F.lit(": "), "c_name").alias("line"))
    write_report(lines, path, order=("c_mktsegment", "c_custkey"), parts=4)
    got = read_lines(spark, path)
    sizes = got.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # four rows
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("part").orderBy("start", "row"))
    return (got.withColumn("own", own).join(F.broadcast(before), "part")
            .select((F.col("before") + F.col("own")).alias("position"), "line"))


def q_sink_roundtrip_answers(spark, sf):
    path = _scratch(spark, "answers")
    said = F.concat("c_name", F.lit(" says "), "c_mktsegment")
    write_answers(table(spark, sf, "customer").select(F.when(F.col("c_mktsegment") != "BUILDING", said).alias("content")), path)
    return read_lines(spark, path).select("line")


def q_csv_rejects(spark, sf):
    """Lines with too few and too many fields and unclosed quotes, told from well-formed ones."""
    key, name, segment = F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_mktsegment")
    kind = F.pmod("c_custkey", F.lit(5))
    line = (F.when(kind == 0, F.concat(key, F.lit(',"'), name, F.lit(', x",'), segment))
            .when(kind == 1, F.concat_ws(",", key, name)).when(kind == 2, F.concat_ws(",", key, name, F.lit("a,b")))
            .when(kind == 3, F.concat(key, F.lit(',"'), name, F.lit(","), segment))
            .otherwise(F.concat(key, F.lit(',"say ""'), name, F.lit('""",'), segment)))
    path = _scratch(spark, "raw")
    table(spark, sf, "customer").select(line.alias("value")).write.text(path)
    good, bad = split_rejects(spark, path, f"{path}_good", f"{path}_bad", "k long, n string, v string", multi_line=False, header=False)
    return good.select(F.col("k").alias("c_custkey"), F.lit(False).alias("rejected"), F.concat_ws("|", "n", "v").alias("content")).unionByName(
        bad.select(F.col("k").alias("c_custkey"), F.lit(True).alias("rejected"), F.col("record").alias("content")))


def q_nan_band(spark, sf):
    """A column with NaN: summaries, bands and buckets treat it as null."""
    rows = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("v"))
    stats = summary(rows, "v", exact=True)
    side = bucket(F.col("v"), [0.0], ["low", "high"])
    counts = rows.agg(F.count_if(side == "low").alias("n_low"), F.count_if(side == "high").alias("n_high"))
    positive = band(rows, "v", lo=0.0, lo_open=True).agg(F.count(F.lit(1)).alias("n")).scalar()
    picked = {s: F.max(F.when(F.col("stat") == s, F.col("value"))) for s in ("count", "mean", "max")}
    one = stats.agg(picked["count"].cast("long").alias("n"), F.round(picked["mean"], 4).alias("mean"),
                    F.round(picked["max"], 4).alias("max"))
    both = counts.select(F.struct("n_low", "n_high").alias("c")).scalar()
    return one.select("n", "mean", "max", positive.alias("n_positive"), both.alias("c")).select(
        "n", "mean", "max", "n_positive", "c.n_low", "c.n_high")


def q_total_guarded(spark, sf):
    """add_total in tolerant mode: without its inputs the table stays as it is."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(F.col("l_discount") * 100).cast("long").alias("positive"),
        F.round(F.col("l_tax") * 100).cast("long").alias("negative"))
    without = add_total(li.drop("negative"), strict=False)
    both = add_total(li, strict=False)
    assert without.columns == ["l_orderkey", "l_linenumber", "positive"]
    return add_ratio(both)


def q_add_year(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return add_year(li, "l_shipdate", "ship_year")


def q_add_ratio(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.round(F.col("l_discount") * 100).cast("long").alias("positive"),
        F.round(F.col("l_tax") * 100).cast("long").alias("negative"))
    return add_ratio(add_total(li, "positive", "negative", "total_reviews"),
                     "positive", "total_reviews", "positive_ratio")


def q_bucket(spark, sf):
    li = add_year(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"),
                  "l_shipdate", "ship_year")
    return li.select("l_orderkey", "l_linenumber", "ship_year",
                     bucket(F.col("ship_year"), [1998], ["old", "new"]).alias("era"))


def q_clean_table(spark, sf):
    return catalog(spark, sf)


# ------------------------------------------------------------------- filters

def q_band_price(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return band(li, "l_extendedprice", hi=50000.0)


def q_band_positive(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount")
    return band(li, "l_discount", lo=0.0, lo_open=True)


def q_band_label(spark, sf):
    clean = catalog(spark, sf)
    return band(clean, "user_score", lo=0.0, hi=25.0, label="name").select(
        "name", "user_score", "release_date")


def q_drop_nulls(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.expr("nullif(l_returnflag, 'A')").alias("flag"),
        F.expr("nullif(l_tax, 0.0)").alias("tax"))
    return drop_nulls(li, ["flag", "tax"])


# ------------------------------------------------------------------ grouping

def q_count_by(spark, sf):
    return count_by(catalog(spark, sf))


def q_count_by_rows(spark, sf):
    return count_by(catalog(spark, sf), count_col=None, out="n_rows")


def q_group_stats(spark, sf):
    return _round_stats(group_stats(catalog(spark, sf)))


def q_group_stats_min5000(spark, sf):
    return _round_stats(group_stats(catalog(spark, sf), min_count=5000))


def q_group_stats_orders(spark, sf):
    orders = add_year(table(spark, sf, "orders"), "o_orderdate", "order_year")
    return group_stats(orders, key="order_year", count_col="o_orderstatus",
                       means={"avg_totalprice": "o_totalprice"}, count_out="n_orders")


def _round_stats(df):
    return df.select("release_year", "game_count", *[_r(c, 2) for c in
                     ("avg_price", "avg_user_score", "avg_metacritic", "avg_pct_pos")])


def q_last_n_counts(spark, sf):
    return last_n(count_by(catalog(spark, sf), order=False), "release_year", 10)


def q_last_n_short(spark, sf):
    return last_n(count_by(catalog(spark, sf), order=False), "release_year", 3)


def q_last_n_stats(spark, sf):
    return _round_stats(last_n(group_stats(catalog(spark, sf), order=False), "release_year", 15))


def q_peak(spark, sf):
    return peak(count_by(catalog(spark, sf), order=False))


def q_span(spark, sf):
    return span(catalog(spark, sf), "release_year")


def q_series(spark, sf):
    return series(group_stats(catalog(spark, sf), order=False), "release_year", "avg_price", 15)


# ------------------------------------------------------------------- profile

def q_shape(spark, sf):
    return shape(table(spark, sf, "lineitem"))


def q_column_profile(spark, sf):
    return column_profile(catalog(spark, sf)).select("ordinal", "column", "non_null")


def _round_value(df):
    return df.select("stat", _r("value"))


def q_summary_exact(spark, sf):
    return _round_value(summary(table(spark, sf, "lineitem"), "l_extendedprice", exact=True))


def q_summary_positive(spark, sf):
    return _round_value(summary(catalog(spark, sf), "metacritic_score", exact=True,
                                lo=0.0, lo_open=True))


def _within(data: DataFrame, value: str, levels: list[float], rel_err: float, got: DataFrame,
            by: str | None = None) -> DataFrame:
    """Does each approximate quantile lie within the rank error asked for?

    ``got`` has (``by``,) ``q``; its true ranks are counted from ``data``.  One
    row per group and level: ``pos``, ``n``, ``within``."""
    x = F.col(value).cast("double")
    keys = [by] if by else []
    rows = data.where(x.isNotNull()).select(*keys, x.alias("_v"))
    if by:
        rows = rows.where(F.col(by).isNotNull())
    rows = attach(rows, got, keys, ["q"])
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[
        F.struct(F.count_if(F.col("_v") < F.get("q", i)).alias("lt"),
                 F.count_if(F.col("_v") <= F.get("q", i)).alias("le")).alias(f"r{i}") for i in range(len(levels))])
    out = F.array(*[F.struct(F.lit(i).alias("pos"), (
        (F.col(f"r{i}.lt") <= (p + rel_err) * F.col("n")) & (F.col(f"r{i}.le") >= (p - rel_err) * F.col("n"))
    ).alias("within")) for i, p in enumerate(levels)])
    return counts.select(*keys, "n", F.inline(out))


def _stat_array(df: DataFrame) -> DataFrame:
    """The quartiles of a long summary as one array ``q``."""
    return df.agg(F.array(*[F.max(F.when(F.col("stat") == s, F.col("value")))
                            for s in ("25%", "50%", "75%")]).alias("q"))


QUARTILE_LEVELS = [0.25, 0.5, 0.75]


def q_summary_approx_events(spark, sf):
    ev = table(spark, sf, "events")
    return _within(ev, "value", QUARTILE_LEVELS, 1e-4, _stat_array(summary(ev, "value")))


def q_center_approx(spark, sf):
    li = table(spark, sf, "lineitem")
    got = center(li, "l_extendedprice").select(F.array("median").alias("q"))
    return _within(li, "l_extendedprice", [0.5], 0.01, got)


def q_bucket_stats_approx(spark, sf):
    clean = _era(catalog(spark, sf)).select("era", "price")
    got = bucket_stats(clean, "era", "price").select("era", F.array("median").alias("q"))
    return _within(clean, "price", [0.5], 1e-4, got, by="era")


def q_box_stats_approx(spark, sf):
    ev = table(spark, sf, "events").select("event_type", "value")
    got = box_stats(ev, "event_type", "value").select("event_type", F.array("q1", "median", "q3").alias("q"))
    return _within(ev, "value", QUARTILE_LEVELS, 1e-4, got, by="event_type")


def q_summary_approx_quantity(spark, sf):
    return _round_value(summary(table(spark, sf, "lineitem"), "l_quantity"))


def q_robust_summary(spark, sf):
    return _round_value(robust_summary(table(spark, sf, "lineitem"), "l_extendedprice",
                                       mean_max=50000.0, exact=True))


def q_center(spark, sf):
    return center(table(spark, sf, "lineitem"), "l_extendedprice", exact=True).select(
        _r("mean"), _r("median"))


def q_center_capped(spark, sf):
    return center(table(spark, sf, "lineitem"), "l_extendedprice", max_value=50000.0,
                  exact=True).select(_r("mean"), _r("median"))


def q_exact_quartiles_large_path(spark, sf):
    """Exact quartiles per return flag, by counted narrowing."""
    q = exact_quantiles(table(spark, sf, "lineitem"), "l_extendedprice", [0.25, 0.5, 0.75],
                        by=["l_returnflag"])
    return q.select("l_returnflag", "n", F.posexplode("q").alias("pos", "value")).select(
        "l_returnflag", "n", "pos", _r("value"))


def q_summary_exact_large_path(spark, sf):
    """summary_exact with Spark's own percentile, asked for by name."""
    return _round_value(summary(table(spark, sf, "lineitem"), "l_extendedprice", exact=True,
                                method="percentile"))


def q_center_large_path(spark, sf):
    """center with Spark's own median, asked for by name."""
    return center(table(spark, sf, "lineitem"), "l_extendedprice", exact=True,
                  method="percentile").select(_r("mean"), _r("median"))


def q_summary_sketch_large_path(spark, sf):
    """Quartiles of the summary by the two-level KLL sketch: within the rank error asked for."""
    li = table(spark, sf, "lineitem")
    return _within(li, "l_extendedprice", QUARTILE_LEVELS, 1e-4,
                   _stat_array(summary(li, "l_extendedprice", sketch="kll")))


def q_approx_quartiles_large_path(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_quantity")
    got = approx_quantiles(li, "l_quantity", QUARTILE_LEVELS, by=["l_returnflag"])
    return _within(li, "l_quantity", QUARTILE_LEVELS, kll_rank_error(SKETCH_K) * 2, got, by="l_returnflag")


# -------------------------------------------------------------------- spread

def _era(clean):
    return clean.withColumn("era", bucket(F.col("release_year"), [1998], ["old", "new"]))


def q_bucket_stats(spark, sf):
    return bucket_stats(_era(catalog(spark, sf)), "era", "price", exact=True).select(
        "era", "n", _r("mean"), _r("median"))


def q_box_stats_events(spark, sf):
    return box_stats(table(spark, sf, "events"), "event_type", "value", exact=True).select(
        "event_type", _r("q1"), _r("median"), _r("q3"), _r("whisker_low"), _r("whisker_high"),
        "n_out", "n")


def q_bucket_stats_large_path(spark, sf):
    """bucket_stats with Spark's own median, asked for by name."""
    return bucket_stats(_era(catalog(spark, sf)), "era", "price", exact=True,
                        method="percentile").select("era", "n", _r("mean"), _r("median"))


def q_box_stats_events_large_path(spark, sf):
    """box_stats_events with Spark's own percentile, asked for by name."""
    return box_stats(table(spark, sf, "events"), "event_type", "value", exact=True,
                     method="percentile").select(
        "event_type", _r("q1"), _r("median"), _r("q3"), _r("whisker_low"), _r("whisker_high"),
        "n_out", "n")


def q_box_stats_era(spark, sf):
    clean = band(_era(catalog(spark, sf)), "price", lo=0.0, label="era")
    return box_stats(clean, "era", "price", exact=True).select(
        "era", _r("q1"), _r("median"), _r("q3"), _r("whisker_low"), _r("whisker_high"),
        "n_out", "n")


# -------------------------------------------------------------------- relate

def q_corr_gated(spark, sf):
    return corr_gated(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice").select(
        "n", _r("corr", 6))


def q_corr_scores(spark, sf):
    return corr_gated(catalog(spark, sf), "metacritic_score", "user_score").select(
        "n", _r("corr", 6))


def q_corr_label(spark, sf):
    c = corr_gated(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return c.select(_r("corr", 6), corr_label(F.col("corr")).alias("label"))


def q_linear_fit(spark, sf):
    return linear_fit(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice").select(
        _r("slope"), _r("intercept"), "n")


def q_predict(spark, sf):
    li = table(spark, sf, "lineitem")
    fit = linear_fit(li, "l_quantity", "l_extendedprice")
    return predict(li.select("l_orderkey", "l_linenumber", "l_quantity"), fit, "l_quantity",
                   "fitted").select("l_orderkey", "l_linenumber", "l_quantity", _r("fitted"))


def q_fit_line(spark, sf):
    return fit_line(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice").select(
        "i", _r("x"), _r("y"))


def q_sample_n(spark, sf):
    return sample_n(table(spark, sf, "events"), "event_id", 5000)


def q_sample_scatter(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return sample_n(li, ["l_orderkey", "l_linenumber"], 5000)


def _scores(spark, sf):
    return catalog(spark, sf).where(
        F.col("metacritic_score").isNotNull() & F.col("user_score").isNotNull())


def q_scatter_fit(spark, sf):
    """The scatter chart's line, fitted over all score pairs (only its points are a sample)."""
    return fit_line(_scores(spark, sf), "metacritic_score", "user_score").select("i", _r("x"), _r("y"))


def q_scatter_corr(spark, sf):
    """The scatter chart's correlation over all pairs, and its wording."""
    c = corr_gated(_scores(spark, sf), "metacritic_score", "user_score")
    return c.select("n", _r("corr", 6), corr_label(F.col("corr")).alias("label"))


def q_sample_nullable(spark, sf):
    """A sample on a key that is null for most rows: they take part too."""
    ev = table(spark, sf, "events").select("event_id", F.when(
        F.col("event_type") == "click", F.col("user_id").cast("string")).alias("user_key"))
    return sample_n(ev, "user_key", 9000)


# -------------------------------------------------------------------- report

def q_summary_lines(spark, sf):
    return summary_lines(summary(table(spark, sf, "lineitem"), "l_quantity", exact=True), digits=2)


def q_report_lines(spark, sf):
    return report_lines(catalog(spark, sf), digits=2, exact=True)


def q_report_lines_any_key(spark, sf):
    """The report over a key with negative and very large values."""
    clean = catalog(spark, sf).withColumn(
        "release_year", (F.col("release_year").cast("long") - 1995) * F.lit(100_000_000_000))
    return report_lines(clean, digits=2, exact=True)


def q_report_lines_large_path(spark, sf):
    """report_lines with Spark's own percentile, asked for by name."""
    return report_lines(catalog(spark, sf), digits=2, exact=True, method="percentile")


def q_report_prompt(spark, sf):
    lines = report_lines(catalog(spark, sf), digits=2, exact=True)
    return chat_requests(prompt_text(lines, DEFAULT_INSTRUCTIONS))


def q_prompt_text(spark, sf):
    conv = table(spark, sf, "conversations")
    return prompt_text(conv, DEFAULT_INSTRUCTIONS, key="conv_id", order=("turn",), text_col="text")


def q_chat_requests(spark, sf):
    conv = table(spark, sf, "conversations")
    return chat_requests(conv.select("conv_id", "turn", "text"), prompt="text").select(
        "conv_id", "turn", "request")


def answer_bodies(conv: DataFrame) -> DataFrame:
    """Model answer bodies of all four kinds, derived from conversation turns."""
    ok = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("text").alias("content"))
                                              .alias("message"))).alias("choices")))
    kind = F.col("turn") % 4
    body = (F.when(kind == 0, ok)
             .when(kind == 1, F.lit('{"choices":[]}'))
             .when(kind == 2, F.lit('{"choices":[{"message":{"content":""}}]}'))
             .otherwise(F.concat(F.lit("not json: "), F.col("text"))))
    return conv.select("conv_id", "turn", body.alias("body"))


def q_chat_content(spark, sf):
    return chat_content(answer_bodies(table(spark, sf, "conversations"))).select(
        "conv_id", "turn", "content", "status")


QUERIES = {
    "select_existing": q_select_existing,
    "clean_numeric_part": q_clean_numeric_part,
    "clean_numeric_events": q_clean_numeric_events,
    "clean_numeric_customer": q_clean_numeric_customer,
    "to_number": q_to_number,
    "parse_date": q_parse_date,
    "parse_date_lenient": q_parse_date_lenient,
    "parse_date_formats": q_parse_date_formats,
    "clean_hostile": q_clean_hostile,
    "sink_roundtrip_parquet": q_sink_roundtrip_parquet,
    "sink_roundtrip_csv": q_sink_roundtrip_csv,
    "sink_roundtrip_report": q_sink_roundtrip_report,
    "sink_roundtrip_answers": q_sink_roundtrip_answers,
    "convert_roundtrip": q_convert_roundtrip,
    "csv_rejects": q_csv_rejects,
    "nan_band": q_nan_band,
    "total_guarded": q_total_guarded,
    "add_year": q_add_year,
    "add_ratio": q_add_ratio,
    "bucket": q_bucket,
    "clean_table": q_clean_table,
    "band_price": q_band_price,
    "band_positive": q_band_positive,
    "band_label": q_band_label,
    "drop_nulls": q_drop_nulls,
    "count_by": q_count_by,
    "count_by_rows": q_count_by_rows,
    "group_stats": q_group_stats,
    "group_stats_min5000": q_group_stats_min5000,
    "group_stats_orders": q_group_stats_orders,
    "last_n_counts": q_last_n_counts,
    "last_n_short": q_last_n_short,
    "last_n_stats": q_last_n_stats,
    "peak": q_peak,
    "span": q_span,
    "series": q_series,
    "shape": q_shape,
    "column_profile": q_column_profile,
    "summary_exact": q_summary_exact,
    "summary_positive": q_summary_positive,
    "summary_approx_events": q_summary_approx_events,
    "summary_approx_quantity": q_summary_approx_quantity,
    "robust_summary": q_robust_summary,
    "center": q_center,
    "center_capped": q_center_capped,
    "exact_quartiles_large_path": q_exact_quartiles_large_path,
    "summary_exact_large_path": q_summary_exact_large_path,
    "center_large_path": q_center_large_path,
    "summary_sketch_large_path": q_summary_sketch_large_path,
    "approx_quartiles_large_path": q_approx_quartiles_large_path,
    "bucket_stats": q_bucket_stats,
    "box_stats_events": q_box_stats_events,
    "bucket_stats_large_path": q_bucket_stats_large_path,
    "box_stats_events_large_path": q_box_stats_events_large_path,
    "box_stats_era": q_box_stats_era,
    "center_approx": q_center_approx,
    "bucket_stats_approx": q_bucket_stats_approx,
    "box_stats_approx": q_box_stats_approx,
    "corr_gated": q_corr_gated,
    "corr_scores": q_corr_scores,
    "corr_label": q_corr_label,
    "linear_fit": q_linear_fit,
    "predict": q_predict,
    "fit_line": q_fit_line,
    "scatter_fit": q_scatter_fit,
    "scatter_corr": q_scatter_corr,
    "sample_nullable": q_sample_nullable,
    "sample_n": q_sample_n,
    "sample_scatter": q_sample_scatter,
    "summary_lines": q_summary_lines,
    "report_lines": q_report_lines,
    "report_lines_large_path": q_report_lines_large_path,
    "report_lines_any_key": q_report_lines_any_key,
    "report_prompt": q_report_prompt,
    "prompt_text": q_prompt_text,
    "chat_requests": q_chat_requests,
    "chat_content": q_chat_content,
}
