"""The analysis report as a DataFrame of ordered text lines.

``report_lines`` turns a cleaned catalogue table into rows
(section int, seq int, line string); see ``report_lines``.  Only finished lines exist afterwards;
``write_report`` writes them in order and ``prompt_text`` joins them into a
prompt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablestats.functions.clean import known
from tablestats.functions.labels import corr_label
from tablestats.operators.groups import (
    DEFAULT_KEY,
    DEFAULT_MEANS,
    LAST_COUNTS,
    LAST_STATS,
    MIN_GROUP_ROWS,
    per_key,
)
from tablestats.operators.profile import (
    MEDIAN_REL_ERROR,
    STAT_ORDER,
    SUMMARY_ACCURACY,
    QUARTILES,
    median,
    summary_struct,
)
from tablestats.operators.moments import count_of, mean_of, merged_correlation, merged_moments, moments, pair_moments
from tablestats.operators.quantiles import (
    approx_series,
    exact_series,
    fused_quantiles,
    own_percentiles,
    rel_err_to_k,
)
from tablestats.operators.relate import MIN_PAIRS

# Report wording and layout (English report), thresholds.
TITLE = "DATASET ANALYSIS RESULTS - SPARK/PARQUET"
DOUBLE_RULE = "=" * 70
SINGLE_RULE = "-" * 50
TOTAL_ROWS = "Total number of games in the dataset: "
COLUMNS_USED = "Number of columns used: "
COLUMNS = "Columns: "
SECTION_COUNTS = "1. GAME COUNT PER RELEASE YEAR (Top 10)"
SECTION_PRICE = "2. BASIC PRICE STATISTICS (price) [Spark summary()]"
SECTION_SCORES = "3. SCORE STATISTICS (Spark summary())"
USER_SCORE = "User Score (Players' Opinion):"
CRITIC_SCORE = "Metacritic Score (Critics' Opinion):"
SECTION_YEARS = "4. PRICE AND SCORE SUMMARY PER YEAR (Spark)"
SECTION_INSIGHTS = "5. KEY INSIGHTS (based on Spark analysis)"
INSIGHT_RECENT = "- Most games have been released in recent years."
INSIGHT_SPAN = "- The dataset covers the period from %s to %s."
INSIGHT_PEAK = "- The year with the most game releases is %s with %s games."
INSIGHT_PRICE = ("- The average game price (Spark) is %.2f USD "
                 "and the approximate median price is %.2f USD.")
INSIGHT_CORR = ("- The correlation between user score (players) and metacritic score "
                "(critics) is %.3f.")
PRICE_MEAN_MAX = 1000.0

# Line order inside a section: fixed lines use small seq numbers, per-key
# lines KEY_SEQ, KEY_SEQ + 1, ... in key order, a closing blank line END_SEQ.
KEY_SEQ = 10
END_SEQ = 100000


def _text(v: Column) -> Column:
    """Python-like text of a value: 'None' for null."""
    return F.coalesce(v.cast("string"), F.lit("None"))


def _number_text(stat: Column, v: Column, digits: int | None) -> Column:
    whole = F.coalesce(v, F.lit(0)).cast("long").cast("string")
    if digits is None:
        frac = v.cast("string")
    else:
        # format_string turns null into the text "null" (cut to the precision)
        frac = F.when(v.isNotNull(), F.format_string(f"%.{digits}f", v))
    return F.coalesce(F.when(stat == "count", whole).otherwise(frac), F.lit("None"))


def summary_lines(summary_df: DataFrame, digits: int | None = None) -> DataFrame:
    """(seq, line) 'stat: value' lines of a long summary, in statistic order.

    ``digits=None`` prints values as Spark prints doubles; an integer prints
    them with that many decimals.
    """
    order = F.array(*[F.lit(s) for s in STAT_ORDER])
    stat = F.col("stat")
    return summary_df.select(
        (F.array_position(order, stat) - 1).cast("int").alias("seq"),
        F.concat(stat, F.lit(": "), _number_text(stat, F.col("value"), digits)).alias("line"))


def _sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _line_sql(section: int, seq: int, expr: str) -> str:
    return f"named_struct('section', {section}, 'seq', {seq}, 'line', {expr})"


def _number_sql(stat: str, v: str, digits: int | None) -> str:
    """SQL text of a summary value: whole count, Spark double text or fixed decimals."""
    if stat == "count":
        text = f"cast(cast(coalesce({v}, 0) as bigint) as string)"
    elif digits is None:
        text = f"cast({v} as string)"
    else:
        # format_string turns null into the text "null" (cut to the precision)
        text = f"CASE WHEN {v} IS NOT NULL THEN format_string('%.{digits}f', {v}) END"
    return f"coalesce({text}, 'None')"


def _summary_block_sql(section: int, first_seq: int, values: list[str],
                       digits: int | None) -> list[str]:
    return [_line_sql(section, first_seq + i,
                      f"concat({_sql_str(stat + ': ')}, {_number_sql(stat, value, digits)})")
            for i, (stat, value) in enumerate(zip(STAT_ORDER, values))]


def report_lines(clean: DataFrame, digits: int | None = None, exact: bool = False,
                 title: str = TITLE, key: str = DEFAULT_KEY,
                 accuracy: int = SUMMARY_ACCURACY, rel_err: float = MEDIAN_REL_ERROR,
                 min_count: int = MIN_GROUP_ROWS, price_max: float = PRICE_MEAN_MAX,
                 min_pairs: int = MIN_PAIRS, sketch: str | None = None,
                 method: str | None = None, label_line: bool = False) -> DataFrame:
    """Report lines (section, seq, line) for a cleaned catalogue table.

    Sections: header; counts of the last 10 years; price summary (mean over
    price <= price_max, the rest over all rows); user and critic score
    summaries over scores > 0; per-year count and means for years with more
    than ``min_count`` rows, last 15; insights (year span, peak year, mean and
    median price <= price_max, correlation of the scores when there are more
    than ``min_pairs`` pairs; with ``label_line`` also the wording of that
    correlation).  ``exact`` switches every quantile from the sketch to the
    exact percentile; ``sketch='gk'`` or ``method='percentile'`` ask for
    Spark's own aggregates instead (see ``profile``).

    Plan: one aggregate over the table (counts, moments, correlation and the
    sketches of four series) and one per key; exact quartiles take two more scans,
    run while the plan is built.  Of the per-key table, however
    many keys it has, only bounded pieces are gathered: the last 10 and the last
    15 keys (top-n per task) and one row with its ends and its peak.  All lines
    are made from these one-row results.
    """
    key_type = dict(clean.dtypes).get(key)
    if key_type not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"report key {key!r} must be an integer year column, got {key_type}")
    price = known(F.col("price").cast("double"))
    user = known(F.col("user_score").cast("double"))
    critic = known(F.col("metacritic_score").cast("double"))
    kept_price = F.when(price <= price_max, price)
    pair = critic.isNotNull() & user.isNotNull()
    pc, pu = F.when(pair, critic), F.when(pair, user)
    means = list(DEFAULT_MEANS.items())
    # quantiles inside the aggregate (if asked for by name), or from a pipeline
    # of their own over the four series
    separate = not fused_quantiles(exact, sketch, method)

    series = [price, F.when(user > 0, user), F.when(critic > 0, critic), kept_price]
    if separate:
        one = _one_scan(clean, series, (critic, user), exact, rel_err_to_k(1.0 / accuracy))
    else:
        met, q = own_percentiles(clean, series, [QUARTILES] * 3 + [[0.5]]) if exact else (clean, [None] * 4)
        one = met.agg(
            F.count(F.lit(1)).alias("n_rows"),
            summary_struct(price, exact, accuracy, mean_of=kept_price, q=q[0]).alias("s_price"),
            summary_struct(series[1], exact, accuracy, q=q[1]).alias("s_user"),
            summary_struct(series[2], exact, accuracy, q=q[2]).alias("s_critic"),
            F.avg(kept_price).alias("c_mean"),
            (F.get(q[3], 0) if exact else median(kept_price, rel_err=rel_err)).alias("c_median"),
            F.count(F.when(pair, F.lit(1))).alias("r_n"),
            F.try_divide(F.covar_pop(pc, pu), F.stddev_pop(pc) * F.stddev_pop(pu)).alias("r"),
        )
    one = one.select(F.struct(*one.columns).alias("G"))

    keyed = per_key(clean, key, "name", DEFAULT_MEANS, "n").withColumnRenamed(key, "k")
    entry = F.struct("k", "n", *[out for out, _ in means])

    def top(rows: DataFrame, n: int) -> Column:
        """The ``n`` largest keys, ascending, as one array."""
        return rows.orderBy(F.desc("k")).limit(n).agg(F.array_sort(F.collect_list(entry))).scalar()

    # The peak is the smallest of the keys with the most rows.
    ends = keyed.agg(F.struct(F.min("k").alias("lo"), F.max("k").alias("hi"),
                              F.min_by(entry, F.struct(-F.col("n"), "k")).alias("peak"))).scalar()
    one = one.select("G", top(keyed, LAST_COUNTS).alias("Y10"),
                     top(keyed.where(F.col("n") > min_count), LAST_STATS).alias("Y15"), ends.alias("E"))
    fields = ("count", "mean", "stddev", "min", "q25", "q50", "q75", "max")

    def block(section: int, first: int, name: str) -> list[str]:
        return _summary_block_sql(section, first, [f"G.{name}.{f}" for f in fields], digits)

    c_median = "G.c_median"
    cols = clean.columns

    def fixed(section: int, seq: int, text: str) -> str:
        return _line_sql(section, seq, _sql_str(text))

    # All fixed lines as one SQL array expression: one parse on the JVM
    # instead of thousands of column-building round trips.
    fixed_lines = [
        fixed(0, 0, title), fixed(0, 1, DOUBLE_RULE), fixed(0, 2, ""),
        _line_sql(0, 3, f"concat({_sql_str(TOTAL_ROWS)}, cast(coalesce(G.n_rows, 0) as string))"),
        fixed(0, 4, COLUMNS_USED + str(len(cols))),
        fixed(0, 5, COLUMNS + ", ".join(cols)),
        fixed(0, 6, ""),
        fixed(1, 0, SECTION_COUNTS), fixed(1, 1, SINGLE_RULE), fixed(1, END_SEQ, ""),
        fixed(2, 0, SECTION_PRICE), fixed(2, 1, SINGLE_RULE),
        *block(2, 2, "s_price"),
        fixed(2, 10, ""),
        fixed(3, 0, SECTION_SCORES), fixed(3, 1, SINGLE_RULE), fixed(3, 2, USER_SCORE),
        *block(3, 3, "s_user"),
        fixed(3, 11, ""), fixed(3, 12, CRITIC_SCORE),
        *block(3, 13, "s_critic"),
        fixed(3, 21, ""),
        fixed(4, 0, SECTION_YEARS), fixed(4, 1, SINGLE_RULE), fixed(4, END_SEQ, ""),
        fixed(5, 0, SECTION_INSIGHTS), fixed(5, 1, SINGLE_RULE), fixed(5, 2, INSIGHT_RECENT),
        _line_sql(5, 3, f"CASE WHEN E.lo IS NOT NULL THEN format_string({_sql_str(INSIGHT_SPAN)}, "
                        "cast(E.lo as string), cast(E.hi as string)) END"),
        _line_sql(5, 4, f"CASE WHEN E.lo IS NOT NULL THEN format_string({_sql_str(INSIGHT_PEAK)}, "
                        "cast(E.peak.k as string), cast(E.peak.n as string)) END"),
        _line_sql(5, 5, f"CASE WHEN G.c_mean IS NOT NULL AND {c_median} IS NOT NULL THEN "
                        f"format_string({_sql_str(INSIGHT_PRICE)}, G.c_mean, {c_median}) END"),
        _line_sql(5, 6, f"CASE WHEN G.r_n > {int(min_pairs)} AND G.r IS NOT NULL THEN "
                        f"format_string({_sql_str(INSIGHT_CORR)}, G.r) END"),
    ]
    if label_line:
        label = F.when(F.col("G.r_n") > min_pairs, corr_label(F.col("G.r")))
        extra = F.array(F.struct(F.lit(5).alias("section"), F.lit(7).alias("seq"), label.alias("line")))
    fixed_array = F.expr("array(" + ", ".join(fixed_lines) + ")")
    if label_line:
        fixed_array = F.concat(fixed_array, extra)

    def key_seq(i: Column) -> Column:
        return (F.lit(KEY_SEQ) + i).cast("int").alias("seq")

    count_lines = F.transform("Y10", lambda e, i: F.struct(
        F.lit(1).alias("section"), key_seq(i),
        F.concat(_text(e["k"]), F.lit(": "), _text(e["n"])).alias("line")))

    def stat_line(e: Column, i: Column) -> Column:
        parts = [_text(e["k"]), F.lit(": count="), _text(e["n"])]
        for out, _ in means:
            parts += [F.lit(f", {out}="), _text(F.round(e[out], 2))]
        return F.struct(F.lit(4).alias("section"), key_seq(i), F.concat(*parts).alias("line"))

    year_lines = F.transform("Y15", stat_line)
    lines = one.select(F.inline(F.concat(fixed_array, count_lines, year_lines)))
    return lines.where(F.col("line").isNotNull())


def _one_scan(clean: DataFrame, series: list[Column], pair: tuple[Column, Column], exact: bool, k: int) -> DataFrame:
    """The report's statistics in one row, from one scan (and two narrower ones for exact quartiles).

    ``series``: price, user score > 0, critic score > 0, price up to the mean's limit."""
    states = [F.struct(F.count(F.lit(1)).alias("n")), *[moments(x) for x in series], pair_moments(*pair)]
    levels = [QUARTILES] * len(series)
    got = (exact_series(clean, series, levels, states=states) if exact
           else approx_series(clean, series, levels, k, states))
    kept_mean = mean_of(F.col("s4"))

    def summary_of(i: int) -> Column:
        m, q = merged_moments(F.col(f"s{i + 1}")), F.col(f"q{i}")
        mean = kept_mean if i == 0 else m["mean"]
        return F.struct(m["count"].alias("count"), mean.alias("mean"), m["stddev"].alias("stddev"), m["min"].alias("min"),
                        F.get(q, 0).alias("q25"), F.get(q, 1).alias("q50"), F.get(q, 2).alias("q75"), m["max"].alias("max"))

    return got.select(count_of(F.col("s0")).alias("n_rows"), *[summary_of(i).alias(name) for i, name in enumerate(("s_price", "s_user", "s_critic"))],
                      kept_mean.alias("c_mean"), F.get("q3", 1).alias("c_median"),
                      count_of(F.col("s5")).alias("r_n"), merged_correlation(F.col("s5")).alias("r"))


def prompt_text(lines: DataFrame, instructions: str, key: str | None = None,
                order: tuple[str, ...] = ("section", "seq"), text_col: str = "line",
                out: str = "prompt") -> DataFrame:
    """Instructions followed by the ordered text lines (each ending in a newline).

    With ``key`` one prompt per key (for example per conversation), else one
    prompt for the whole line table.  Lines are ordered by ``order`` and then
    by text, inside the aggregate of each key.  Each prompt is one string, so
    the lines of one key are gathered in one task: the input is a report or a
    conversation, whose size is that of the prompt itself.
    """
    item = F.struct(*[F.col(c) for c in order], F.col(text_col).alias("_t"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda s: s["_t"]), "\n")
    text = F.concat(F.lit(instructions), body, F.lit("\n")).alias(out)
    if key is None:
        return lines.agg(text)
    return lines.groupBy(key).agg(text)
