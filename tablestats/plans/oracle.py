"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each entry reads the driver's tables (views ``lineitem``, ``events``, ...)
and must return the same columns, types and values as the Spark query of the
same name in ``bindings.QUERIES``.
"""

from __future__ import annotations

from tablestats.plans import report as rp
from tablestats.plans.chat import DEFAULT_INSTRUCTIONS, DEFAULT_MODEL


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


CLEAN_CTE = """
clean_base AS (
  SELECT nullif(l_returnflag, 'A') AS name,
         l_extendedprice AS price,
         l_quantity AS user_score,
         round(l_discount * 100) + 0.0 AS metacritic_score,
         CAST(round(l_discount * 100) AS BIGINT) AS positive,
         CAST(round(l_tax * 100) AS BIGINT) AS negative,
         CAST(l_linenumber AS DOUBLE) AS pct_pos_total,
         l_linestatus AS categories,
         l_returnflag AS genres,
         CAST(l_suppkey AS VARCHAR) AS tags,
         CAST(l_shipdate AS DATE) AS release_date,
         CAST(year(l_shipdate) AS INTEGER) AS release_year
  FROM lineitem),
clean AS (
  SELECT *, positive + negative AS total_reviews,
         CASE WHEN positive + negative > 0
              THEN CAST(positive AS DOUBLE) / CAST(positive + negative AS DOUBLE) * 100 END
           AS positive_ratio
  FROM clean_base)"""

CLEAN_COLUMNS = ["name", "price", "user_score", "metacritic_score", "positive", "negative",
                 "pct_pos_total", "categories", "genres", "tags", "release_date",
                 "release_year", "total_reviews", "positive_ratio"]

ERA = "CASE WHEN release_year <= 1998 THEN 'old' WHEN release_year > 1998 THEN 'new' END"

EVENT_DATE_TEXT = """CASE WHEN event_type = 'click' THEN strftime(ts, '%b %-d, %Y')
            WHEN event_type = 'error' THEN 'Coming soon'
            WHEN event_type = 'signup' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%d') END"""

STATS = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")


def _summary_aggs(x: str, where: str | None, prefix: str, mean_where: str | None = None) -> str:
    f = f" FILTER (WHERE {where})" if where else ""
    mf = f" FILTER (WHERE {mean_where})" if mean_where else f
    return ",\n  ".join([
        f"count({x}){f} AS {prefix}0",
        f"avg({x}){mf} AS {prefix}1",
        f"stddev_samp({x}){f} AS {prefix}2",
        f"min({x}){f} AS {prefix}3",
        f"quantile_cont({x}, 0.25){f} AS {prefix}4",
        f"quantile_cont({x}, 0.5){f} AS {prefix}5",
        f"quantile_cont({x}, 0.75){f} AS {prefix}6",
        f"max({x}){f} AS {prefix}7",
    ])


def _summary_long(aggs: str, source: str, with_clean: bool = False, disc: bool = False) -> str:
    if disc:
        aggs = aggs.replace("quantile_cont", "quantile_disc")
    pre = f"WITH {CLEAN_CTE.strip()}, " if with_clean else "WITH "
    rows = " UNION ALL ".join(
        f"SELECT {_lit(s)} AS stat, round(CAST(s{i} AS DOUBLE), 4) AS value FROM s"
        for i, s in enumerate(STATS))
    return f"{pre}s AS (SELECT {aggs} FROM {source}) {rows}"


def _with_clean(body: str, *ctes: str) -> str:
    """``body`` after the cleaned-catalogue CTE and any further CTEs."""
    extra = "".join(f", {c}" for c in ctes)
    return f"WITH {CLEAN_CTE.strip()}{extra} {body}"


COUNT_BY = ("SELECT release_year, count(name) AS game_count FROM clean "
            "WHERE release_year IS NOT NULL GROUP BY release_year")
GROUP_STATS = """SELECT * FROM (
  SELECT release_year, count(name) AS game_count,
         round(avg(price), 2) AS avg_price, round(avg(user_score), 2) AS avg_user_score,
         round(avg(metacritic_score), 2) AS avg_metacritic, round(avg(pct_pos_total), 2) AS avg_pct_pos
  FROM clean WHERE release_year IS NOT NULL GROUP BY release_year) WHERE game_count > {min_count}"""


def _box_sql(source: str, bucket: str, value: str, where: str = "TRUE", with_clean=False) -> str:
    body = f"""d AS (SELECT {bucket} AS b, CAST({value} AS DOUBLE) AS v FROM {source}
           WHERE {bucket} IS NOT NULL AND {value} IS NOT NULL AND {where}),
q AS (SELECT b, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med,
             quantile_cont(v, 0.75) AS q3 FROM d GROUP BY b),
f AS (SELECT b, q1, med, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q),
w AS (SELECT d.b, f.q1, f.med, f.q3,
             min(CASE WHEN v >= lo THEN v END) AS wl, max(CASE WHEN v <= hi THEN v END) AS wh,
             count(CASE WHEN v < lo OR v > hi THEN 1 END) AS n_out, count(v) AS n
      FROM d JOIN f ON d.b = f.b GROUP BY d.b, f.q1, f.med, f.q3)
SELECT b AS {bucket.split('.')[-1]}, round(q1, 4) AS q1, round(med, 4) AS median, round(q3, 4) AS q3,
       round(least(coalesce(wl, q1), q1), 4) AS whisker_low,
       round(greatest(coalesce(wh, q3), q3), 4) AS whisker_high, n_out, n FROM w"""
    return f"WITH {CLEAN_CTE.strip()}, {body}" if with_clean else f"WITH {body}"


def _report_sql() -> str:
    price_aggs = _summary_aggs("price", None, "p", mean_where=f"price <= {rp.PRICE_MEAN_MAX}")
    user_aggs = _summary_aggs("user_score", "user_score > 0", "u")
    critic_aggs = _summary_aggs("metacritic_score", "metacritic_score > 0", "m")
    g = f"""g AS (SELECT count(*) AS n_rows,
  {price_aggs},
  {user_aggs},
  {critic_aggs},
  avg(price) FILTER (WHERE price <= {rp.PRICE_MEAN_MAX}) AS c_mean,
  median(price) FILTER (WHERE price <= {rp.PRICE_MEAN_MAX}) AS c_median,
  count(*) FILTER (WHERE metacritic_score IS NOT NULL AND user_score IS NOT NULL) AS r_n,
  corr(metacritic_score, user_score) AS r
  FROM clean)"""
    y = """y AS (SELECT release_year, count(name) AS game_count, avg(price) AS avg_price,
  avg(user_score) AS avg_user_score, avg(metacritic_score) AS avg_metacritic,
  avg(pct_pos_total) AS avg_pct_pos FROM clean WHERE release_year IS NOT NULL GROUP BY release_year)"""

    def fixed(section, seq, text):
        return f"SELECT {section} AS section, {seq} AS seq, {_lit(text)} AS line"

    def stat_lines(section, first, prefix):
        out = []
        for i, s in enumerate(STATS):
            v = f"{prefix}{i}"
            val = (f"CAST(CAST({v} AS BIGINT) AS VARCHAR)" if s == "count"
                   else f"printf('%.2f', {v})")
            out.append(f"SELECT {section}, {first + i}, {_lit(s + ': ')} || coalesce({val}, 'None') FROM g")
        return out

    cols = ", ".join(CLEAN_COLUMNS)
    parts = [
        fixed(0, 0, rp.TITLE), fixed(0, 1, rp.DOUBLE_RULE), fixed(0, 2, ""),
        f"SELECT 0, 3, {_lit(rp.TOTAL_ROWS)} || CAST(n_rows AS VARCHAR) FROM g",
        fixed(0, 4, rp.COLUMNS_USED + str(len(CLEAN_COLUMNS))),
        fixed(0, 5, rp.COLUMNS + cols), fixed(0, 6, ""),
        fixed(1, 0, rp.SECTION_COUNTS), fixed(1, 1, rp.SINGLE_RULE), fixed(1, rp.END_SEQ, ""),
        fixed(2, 0, rp.SECTION_PRICE), fixed(2, 1, rp.SINGLE_RULE),
        *stat_lines(2, 2, "p"), fixed(2, 10, ""),
        fixed(3, 0, rp.SECTION_SCORES), fixed(3, 1, rp.SINGLE_RULE), fixed(3, 2, rp.USER_SCORE),
        *stat_lines(3, 3, "u"), fixed(3, 11, ""), fixed(3, 12, rp.CRITIC_SCORE),
        *stat_lines(3, 13, "m"), fixed(3, 21, ""),
        fixed(4, 0, rp.SECTION_YEARS), fixed(4, 1, rp.SINGLE_RULE), fixed(4, rp.END_SEQ, ""),
        fixed(5, 0, rp.SECTION_INSIGHTS), fixed(5, 1, rp.SINGLE_RULE), fixed(5, 2, rp.INSIGHT_RECENT),
        f"SELECT 5, 5, printf({_lit(rp.INSIGHT_PRICE)}, c_mean, c_median) FROM g "
        "WHERE c_mean IS NOT NULL AND c_median IS NOT NULL",
        f"SELECT 5, 6, printf({_lit(rp.INSIGHT_CORR)}, r) FROM g "
        f"WHERE r_n > {10} AND r IS NOT NULL",
        f"""SELECT 1, CAST({rp.KEY_SEQ - 1} + row_number() OVER (ORDER BY release_year) AS INTEGER), CAST(release_year AS VARCHAR) || ': ' ||
               CAST(game_count AS VARCHAR)
            FROM (SELECT * FROM y ORDER BY release_year DESC LIMIT 10)""",
        f"""SELECT 4, CAST({rp.KEY_SEQ - 1} + row_number() OVER (ORDER BY release_year) AS INTEGER), CAST(release_year AS VARCHAR) || ': count=' ||
               CAST(game_count AS VARCHAR) ||
               ', avg_price=' || coalesce(CAST(round(avg_price, 2) AS VARCHAR), 'None') ||
               ', avg_user_score=' || coalesce(CAST(round(avg_user_score, 2) AS VARCHAR), 'None') ||
               ', avg_metacritic=' || coalesce(CAST(round(avg_metacritic, 2) AS VARCHAR), 'None') ||
               ', avg_pct_pos=' || coalesce(CAST(round(avg_pct_pos, 2) AS VARCHAR), 'None')
            FROM (SELECT * FROM y WHERE game_count > 30 ORDER BY release_year DESC LIMIT 15)""",
        f"""SELECT 5, 3, printf({_lit(rp.INSIGHT_SPAN)}, CAST(lo AS VARCHAR), CAST(hi AS VARCHAR))
            FROM (SELECT min(release_year) AS lo, max(release_year) AS hi FROM y) WHERE lo IS NOT NULL""",
        f"""SELECT 5, 4, printf({_lit(rp.INSIGHT_PEAK)}, CAST(release_year AS VARCHAR),
               CAST(game_count AS VARCHAR))
            FROM (SELECT * FROM y ORDER BY game_count DESC, release_year ASC LIMIT 1)""",
    ]
    union = "\nUNION ALL ".join(parts)
    return f"WITH {CLEAN_CTE.strip()},\n{g},\n{y},\nlines AS ({union})\nSELECT section, seq, line FROM lines"


def _report_body() -> str:
    """The report query without the cleaned-catalogue CTE (for nesting)."""
    full = _report_sql()
    return "WITH " + full[len(f"WITH {CLEAN_CTE.strip()},"):].lstrip()


def _num(x: str) -> str:
    """Digits with at most one point, a sign in front, an exponent behind; finite."""
    body, exponent = f"lower(trim({x}, ' \t\n\r\f\v'))", "[+-]?[0-9]+"
    mantissa = f"ltrim(split_part({body}, 'e', 1), '+-')"
    digits = f"replace({mantissa}, '.', '')"
    return (f"CASE WHEN regexp_full_match({digits}, '[0-9]+') AND length({mantissa}) - length({digits}) <= 1 "
            f"AND length(split_part({body}, 'e', 1)) - length({mantissa}) <= 1 "
            f"AND (NOT contains({body}, 'e') OR regexp_full_match(substr({body}, instr({body}, 'e') + 1), "
            f"'{exponent}')) AND isfinite(TRY_CAST({body} AS DOUBLE)) THEN TRY_CAST({body} AS DOUBLE) END")


def _strip(x: str) -> str:
    return f"TRY_CAST(regexp_replace({x}, '[^0-9.]', '', 'g') AS DOUBLE)"


ORACLE_SQL = {
    "select_existing": "SELECT p_partkey, p_brand, p_size FROM part",
    "clean_numeric_part": (f"SELECT p_partkey, {_strip('p_brand')} AS p_brand, "
                           f"{_strip('p_type')} AS p_type, CAST(p_size AS DOUBLE) AS p_size FROM part"),
    "clean_numeric_events": f"SELECT event_id, {_strip('props')} AS props FROM events",
    "clean_numeric_customer": (f"SELECT c_custkey, {_strip('c_mktsegment')} AS c_mktsegment, "
                               f"{_strip('CAST(c_acctbal AS VARCHAR)')} AS c_acctbal FROM customer"),
    "to_number": (f"SELECT c_custkey, {_num('c_mktsegment')} AS segment_num, "
                  f"{_num('CAST(c_acctbal AS VARCHAR)')} AS acctbal_num, "
                  f"{_num('c_name')} AS name_num FROM customer"),
    "parse_date": (f"SELECT event_id, date_text, CAST(try_strptime(date_text, '%Y-%m-%d') AS DATE) "
                   f"AS release_date FROM (SELECT event_id, {EVENT_DATE_TEXT} AS date_text FROM events)"),
    "parse_date_lenient": (
        "SELECT event_id, date_text, CAST(coalesce(try_strptime(date_text, '%Y-%m-%d'), "
        "try_strptime(date_text, '%Y-%m-%d %H:%M:%S'), try_strptime(date_text, '%b %d, %Y')) AS DATE) "
        f"AS release_date FROM (SELECT event_id, {EVENT_DATE_TEXT} AS date_text FROM events)"),
    "add_year": ("SELECT l_orderkey, l_linenumber, l_shipdate, "
                 "CAST(year(l_shipdate) AS INTEGER) AS ship_year FROM lineitem"),
    "add_ratio": """SELECT l_orderkey, l_linenumber, positive, negative, positive + negative AS total_reviews,
  CASE WHEN positive + negative > 0
       THEN CAST(positive AS DOUBLE) / CAST(positive + negative AS DOUBLE) * 100 END AS positive_ratio
FROM (SELECT l_orderkey, l_linenumber, CAST(round(l_discount * 100) AS BIGINT) AS positive,
             CAST(round(l_tax * 100) AS BIGINT) AS negative FROM lineitem)""",
    "bucket": ("SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS ship_year, "
               "CASE WHEN year(l_shipdate) <= 1998 THEN 'old' WHEN year(l_shipdate) > 1998 THEN 'new' END "
               "AS era FROM lineitem"),
    "clean_table": _with_clean("SELECT * FROM clean"),
    "band_price": ("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem "
                   "WHERE l_extendedprice IS NOT NULL AND l_extendedprice <= 50000"),
    "band_positive": ("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem "
                      "WHERE l_discount IS NOT NULL AND l_discount > 0"),
    "band_label": _with_clean("SELECT name, user_score, release_date FROM clean WHERE user_score "
                              "IS NOT NULL AND user_score >= 0 AND user_score <= 25 AND name IS NOT NULL"),
    "drop_nulls": ("SELECT * FROM (SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'A') AS flag, "
                   "nullif(l_tax, 0.0) AS tax FROM lineitem) WHERE flag IS NOT NULL AND tax IS NOT NULL"),
    "count_by": _with_clean(COUNT_BY),
    "count_by_rows": _with_clean("SELECT release_year, count(*) AS n_rows FROM clean "
                                 "WHERE release_year IS NOT NULL GROUP BY release_year"),
    "group_stats": _with_clean(GROUP_STATS.format(min_count=30)),
    "group_stats_min5000": _with_clean(GROUP_STATS.format(min_count=5000)),
    "group_stats_orders": ("SELECT * FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, "
                           "count(o_orderstatus) AS n_orders, round(avg(o_totalprice), 2) AS avg_totalprice "
                           "FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1) WHERE n_orders > 30"),
    "last_n_counts": _with_clean("SELECT * FROM c ORDER BY release_year DESC LIMIT 10",
                                 f"c AS ({COUNT_BY})"),
    "last_n_short": _with_clean("SELECT * FROM c ORDER BY release_year DESC LIMIT 3",
                                f"c AS ({COUNT_BY})"),
    "last_n_stats": _with_clean("SELECT * FROM s ORDER BY release_year DESC LIMIT 15",
                                f"s AS ({GROUP_STATS.format(min_count=30)})"),
    "peak": _with_clean("SELECT release_year, game_count FROM c "
                        "ORDER BY game_count DESC, release_year ASC LIMIT 1", f"c AS ({COUNT_BY})"),
    "span": _with_clean("SELECT min(release_year) AS first_release_year, "
                        "max(release_year) AS last_release_year FROM clean"),
    "series": _with_clean("SELECT release_year, avg_price "
                          "FROM (SELECT * FROM s ORDER BY release_year DESC LIMIT 15) "
                          "WHERE avg_price IS NOT NULL", f"s AS ({GROUP_STATS.format(min_count=30)})"),
    "shape": "SELECT count(*) AS n_rows, 11 AS n_cols FROM lineitem",
    "column_profile": _with_clean(" UNION ALL ".join(
        f"SELECT {i} AS ordinal, {_lit(c)} AS \"column\", count({c}) AS non_null FROM clean"
        for i, c in enumerate(CLEAN_COLUMNS))),
    "summary_exact": _summary_long(_summary_aggs("l_extendedprice", None, "s"), "lineitem"),
    "summary_positive": _summary_long(_summary_aggs("metacritic_score", None, "s"),
                                      "clean WHERE metacritic_score IS NOT NULL AND metacritic_score > 0",
                                      with_clean=True),
    "summary_approx_quantity": _summary_long(_summary_aggs("l_quantity", None, "s"), "lineitem", disc=True),
    "robust_summary": _summary_long(_summary_aggs("l_extendedprice", None, "s",
                                                  mean_where="l_extendedprice <= 50000"), "lineitem"),
    "center": ("SELECT round(avg(l_extendedprice), 4) AS mean, round(median(l_extendedprice), 4) AS median "
               "FROM lineitem"),
    "center_capped": ("SELECT round(avg(l_extendedprice), 4) AS mean, "
                      "round(median(l_extendedprice), 4) AS median FROM lineitem "
                      "WHERE l_extendedprice <= 50000"),
    "exact_quartiles_large_path": " UNION ALL ".join(
        f"SELECT l_returnflag, count(*) AS n, {i} AS pos, "
        f"round(quantile_cont(l_extendedprice, {p}), 4) AS value FROM lineitem "
        "WHERE l_extendedprice IS NOT NULL GROUP BY l_returnflag"
        for i, p in enumerate((0.25, 0.5, 0.75))),
    "bucket_stats": _with_clean("SELECT era, count(price) AS n, round(avg(price), 4) AS mean, "
                                "round(median(price), 4) AS median FROM e "
                                "WHERE era IS NOT NULL AND price IS NOT NULL GROUP BY era",
                                f"e AS (SELECT *, {ERA} AS era FROM clean)"),
    "box_stats_events": _box_sql("events", "event_type", "value"),
    "box_stats_era": _box_sql(f"(SELECT *, {ERA} AS era FROM clean)", "era", "price",
                              where="price >= 0", with_clean=True),
    "corr_gated": ("SELECT count(*) AS n, round(CASE WHEN count(*) > 10 THEN "
                   "corr(l_quantity, l_extendedprice) END, 6) AS corr FROM lineitem "
                   "WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL"),
    "corr_scores": _with_clean("SELECT count(*) AS n, round(CASE WHEN count(*) > 10 THEN "
                               "corr(metacritic_score, user_score) END, 6) AS corr FROM clean "
                               "WHERE metacritic_score IS NOT NULL AND user_score IS NOT NULL"),
    "corr_label": """SELECT round(r, 6) AS corr,
  CASE WHEN r > 0.7 THEN 'High positive correlation: Players and critics tend to agree'
       WHEN r > 0.3 THEN 'Moderate positive correlation: There is some agreement'
       WHEN r IS NOT NULL THEN 'Low correlation: Players and critics have different opinions' END AS label
FROM (SELECT CASE WHEN count(*) > 10 THEN corr(l_quantity, l_extendedprice) END AS r FROM lineitem
      WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL)""",
    "linear_fit": ("SELECT round(CASE WHEN count(*) > 10 THEN regr_slope(l_extendedprice, l_quantity) END, 4) "
                   "AS slope, round(CASE WHEN count(*) > 10 THEN regr_intercept(l_extendedprice, l_quantity) "
                   "END, 4) AS intercept, count(*) AS n FROM lineitem "
                   "WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL"),
    "predict": """WITH fit AS (SELECT regr_slope(l_extendedprice, l_quantity) AS s,
                    regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem
                    WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL)
SELECT l_orderkey, l_linenumber, l_quantity, round(s * l_quantity + b, 4) AS fitted
FROM lineitem CROSS JOIN fit""",
    "fit_line": """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS s,
                  regr_intercept(l_extendedprice, l_quantity) AS b, count(*) AS n,
                  min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem
                  WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL),
p AS (SELECT CAST(t.i AS INTEGER) AS i,
             CASE WHEN t.i = 99 THEN hi ELSE t.i * ((hi - lo) / 99.0) + lo END AS x, s, b
      FROM f CROSS JOIN range(0, 100) AS t(i) WHERE s IS NOT NULL AND n > 10)
SELECT i, round(x, 4) AS x, round(s * x + b, 4) AS y FROM p""",
    "sample_nullable": ("SELECT event_id, user_key FROM (SELECT event_id, CASE WHEN event_type = 'click' "
                        "THEN CAST(user_id AS VARCHAR) END AS user_key FROM events) "
                        "ORDER BY md5(coalesce(user_key, '')), user_key NULLS LAST, md5(CAST(event_id AS VARCHAR)), event_id LIMIT 9000"),
    "sample_n": "SELECT * FROM events ORDER BY md5(CAST(event_id AS VARCHAR)), event_id LIMIT 5000",
    "sample_scatter": ("SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem "
                       "ORDER BY md5(concat_ws(chr(31), CAST(l_orderkey AS VARCHAR), "
                       "CAST(l_linenumber AS VARCHAR))), l_orderkey, l_linenumber, l_quantity, "
                       "l_extendedprice LIMIT 5000"),
    "summary_lines": ("WITH s AS (SELECT " + _summary_aggs("l_quantity", None, "s") + " FROM lineitem) "
                      + " UNION ALL ".join(
                          f"SELECT {i} AS seq, {_lit(st + ': ')} || coalesce("
                          + ("CAST(CAST(s0 AS BIGINT) AS VARCHAR)" if st == "count"
                             else f"printf('%.2f', s{i})") + ", 'None') AS line FROM s"
                          for i, st in enumerate(STATS))),
    "report_lines": _report_sql(),
    "scatter_fit": _with_clean("""SELECT i, round(x, 4) AS x, round(s * x + b, 4) AS y FROM (
  SELECT CAST(t.i AS INTEGER) AS i,
         CASE WHEN t.i = 99 THEN hi ELSE t.i * ((hi - lo) / 99.0) + lo END AS x, s, b
  FROM f CROSS JOIN range(0, 100) AS t(i) WHERE s IS NOT NULL AND n > 10)""",
        """f AS (SELECT regr_slope(user_score, metacritic_score) AS s,
          regr_intercept(user_score, metacritic_score) AS b, count(*) AS n,
          min(metacritic_score) AS lo, max(metacritic_score) AS hi
          FROM clean WHERE metacritic_score IS NOT NULL AND user_score IS NOT NULL)"""),
    "report_prompt": (f"WITH {CLEAN_CTE.strip()}, rep AS ({{report}}) "
                      f"SELECT prompt, CAST(to_json({{{{'model': {_lit(DEFAULT_MODEL)}, "
                      "'messages': [{{'role': 'user', 'content': prompt}}], 'temperature': 0.5, "
                      "'max_tokens': -1, 'stream': false}}) AS VARCHAR) AS request FROM ("
                      f"SELECT {_lit(DEFAULT_INSTRUCTIONS)} || string_agg(line, chr(10) "
                      "ORDER BY section, seq, line) || chr(10) AS prompt FROM rep)"),
    "prompt_text": (f"SELECT conv_id, {_lit(DEFAULT_INSTRUCTIONS)} || "
                    "string_agg(text, chr(10) ORDER BY turn, text) || chr(10) AS prompt "
                    "FROM conversations GROUP BY conv_id"),
    "chat_requests": (f"SELECT conv_id, turn, CAST(to_json({{'model': {_lit(DEFAULT_MODEL)}, "
                      "'messages': [{'role': 'user', 'content': text}], 'temperature': 0.5, "
                      "'max_tokens': -1, 'stream': false}) AS VARCHAR) AS request "
                      "FROM conversations"),
    "chat_content": """SELECT conv_id, turn,
  CASE WHEN turn % 4 = 0 AND text <> '' THEN text END AS content,
  CASE turn % 4 WHEN 0 THEN CASE WHEN text = '' THEN 'empty' ELSE 'ok' END
                WHEN 1 THEN 'no_choices' WHEN 2 THEN 'empty' ELSE 'bad_json' END AS status
FROM conversations""",
}

ORACLE_SQL["report_prompt"] = ORACLE_SQL["report_prompt"].format(report=_report_body())

# The forced large-input paths return exactly what the base queries return.
ORACLE_SQL["box_stats_events_large_path"] = ORACLE_SQL["box_stats_events"]
ORACLE_SQL["summary_exact_large_path"] = ORACLE_SQL["summary_exact"]
ORACLE_SQL["center_large_path"] = ORACLE_SQL["center"]
ORACLE_SQL["bucket_stats_large_path"] = ORACLE_SQL["bucket_stats"]
ORACLE_SQL["report_lines_large_path"] = ORACLE_SQL["report_lines"]


def _within_sql(source: str, value: str, levels: tuple[float, ...], by: str | None = None,
                where: str = "TRUE") -> str:
    """Every approximate quantile must be within its rank error: rows of TRUE."""
    key = f"{by}, " if by else ""
    return " UNION ALL ".join(
        f"SELECT {key}{i} AS pos, count(*) AS n, TRUE AS within FROM {source} "
        f"WHERE {value} IS NOT NULL AND {where}" + (f" AND {by} IS NOT NULL GROUP BY {by}" if by else "")
        for i in range(len(levels)))


_QUARTILES = (0.25, 0.5, 0.75)
ORACLE_SQL["summary_approx_events"] = _within_sql("events", "value", _QUARTILES)
ORACLE_SQL["summary_sketch_large_path"] = _within_sql("lineitem", "l_extendedprice", _QUARTILES)
ORACLE_SQL["approx_quartiles_large_path"] = _within_sql("lineitem", "l_quantity", _QUARTILES, "l_returnflag")
ORACLE_SQL["center_approx"] = _within_sql("lineitem", "l_extendedprice", (0.5,))
ORACLE_SQL["bucket_stats_approx"] = _with_clean(
    _within_sql("e", "price", (0.5,), "era"), f"e AS (SELECT *, {ERA} AS era FROM clean)")
ORACLE_SQL["box_stats_approx"] = _within_sql("events", "value", _QUARTILES, "event_type")

#: Ten ways to write one date, by the remainder of the event's number.
_DATE_STYLES = ("%Y-%m-%d", "%Y-%-m-%-d", "%Y/%-m/%-d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%b %-d, %Y",
                "%B %-d, %Y", "%-d %b, %Y", "%-d %b %Y", "%-m/%-d/%Y")
ORACLE_SQL["parse_date_formats"] = (
    "SELECT event_id, CASE event_id % 10 " + " ".join(
        f"WHEN {i} THEN strftime(ts, {_lit(f)})" for i, f in enumerate(_DATE_STYLES))
    + " END AS date_text, CAST(ts AS DATE) AS release_date FROM events")

#: Text beyond the range of doubles or longs, NaN and infinities, made from given columns.
ORACLE_SQL["clean_hostile"] = """SELECT c_custkey,
  CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS DOUBLE) END AS number,
  CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS DOUBLE)
       WHEN c_custkey % 3 = 1 THEN 1.0 END AS stripped,
  CASE WHEN c_custkey % 3 = 0 THEN c_custkey END AS positive,
  CASE WHEN c_custkey % 3 = 0 THEN c_custkey + 1 END AS total_reviews,
  CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END AS price,
  CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END AS pct_pos_total,
  CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END AS passed
FROM customer"""
# Sinks: what was written is read back.
ORACLE_SQL["sink_roundtrip_parquet"] = "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer"
_MESSY = ("CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name || ', \"' || c_mktsegment || '\"' || chr(10) || '\\ end' END")
ORACLE_SQL["sink_roundtrip_csv"] = f"SELECT c_custkey, c_acctbal, {_MESSY} AS note FROM customer"
ORACLE_SQL["convert_roundtrip"] = ORACLE_SQL["sink_roundtrip_csv"]
ORACLE_SQL["sink_roundtrip_report"] = (
    "SELECT row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS position, c_mktsegment || ': ' || c_name AS line FROM customer")
ORACLE_SQL["sink_roundtrip_answers"] = (
    "SELECT c_name || ' says ' || c_mktsegment AS line FROM customer WHERE c_mktsegment <> 'BUILDING'")
ORACLE_SQL["csv_rejects"] = """SELECT c_custkey, c_custkey % 5 NOT IN (0, 4) AS rejected, CASE c_custkey % 5
  WHEN 0 THEN c_name || ', x|' || c_mktsegment WHEN 4 THEN 'say "' || c_name || '"|' || c_mktsegment
  WHEN 1 THEN c_custkey || ',' || c_name WHEN 2 THEN c_custkey || ',' || c_name || ',a,b'
  ELSE c_custkey || ',"' || c_name || ',' || c_mktsegment END AS content
FROM customer"""
ORACLE_SQL["nan_band"] = """SELECT count(*) AS n, round(avg(v), 4) AS mean, round(max(v), 4) AS max,
  count(*) FILTER (WHERE v > 0) AS n_positive, count(*) FILTER (WHERE v <= 0) AS n_low,
  count(*) FILTER (WHERE v > 0) AS n_high
FROM (SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS v FROM customer) WHERE v IS NOT NULL"""
ORACLE_SQL["total_guarded"] = ORACLE_SQL["add_ratio"].replace(
    "positive + negative AS total_reviews,\n  CASE", "positive + negative AS total_reviews, CASE")
ORACLE_SQL["report_lines_any_key"] = ORACLE_SQL["report_lines"].replace(
    "CAST(year(l_shipdate) AS INTEGER) AS release_year",
    "(CAST(year(l_shipdate) AS BIGINT) - 1995) * 100000000000 AS release_year")
ORACLE_SQL["scatter_corr"] = _with_clean(
    "SELECT n, round(r, 6) AS corr, CASE WHEN r > 0.7 THEN 'High positive correlation: Players and critics tend to agree' "
    "WHEN r > 0.3 THEN 'Moderate positive correlation: There is some agreement' "
    "WHEN r IS NOT NULL THEN 'Low correlation: Players and critics have different opinions' END AS label "
    "FROM (SELECT count(*) AS n, CASE WHEN count(*) > 10 THEN corr(metacritic_score, user_score) END AS r "
    "FROM clean WHERE metacritic_score IS NOT NULL AND user_score IS NOT NULL)")
