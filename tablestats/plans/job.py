"""The whole catalogue analysis as one Spark job sequence.

read (Parquet copy, or CSV converted once) -> clean -> cleaned Parquet (and
CSV) sinks -> every statistic from the written Parquet table -> ordered text
report -> prompt and chat request rows, plus the chart inputs (per-year price
series, repeatable scatter sample with its fitted line, box numbers and
mean/median per era) as small Parquet tables.

The cleaned table is written once and read back: later scans get column
pruning and predicate pushdown on typed columns, lineage is cut at a durable
table (an executor lost later only re-reads Parquet, never re-cleans the raw
text), and the raw input is scanned once for everything.
"""

from __future__ import annotations

import os
import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestats.functions.clean import bucket
from tablestats.functions.labels import corr_label
from tablestats.operators.columns import clean_table
from tablestats.operators.filters import band
from tablestats.operators.groups import group_stats, series
from tablestats.operators.relate import MIN_PAIRS, SAMPLE_ROWS, corr_gated, fit_line, sample_n
from tablestats.operators.spread import box_stats, bucket_stats
from tablestats.plans.chat import DEFAULT_INSTRUCTIONS, DEFAULT_MODEL, chat_content, chat_requests
from tablestats.plans.report import prompt_text, report_lines
from tablestats.sources.io import read_or_convert, read_table, write_answers, write_report, write_table


def analyze(spark: SparkSession, out_dir: str, raw: DataFrame | None = None,
            base: str | None = None, name: str | None = None,
            spec: Mapping[str, str | Column] | None = None, exact: bool = False,
            write_csv: bool = True, csv_single: bool = False,
            model: str = DEFAULT_MODEL, sketch: str | None = None,
            charts: bool = True, answers: DataFrame | None = None, body: str = "body",
            multi_line: bool = True) -> dict:
    """Run the analysis; return output paths and the two run times (seconds).

    Input: ``raw`` DataFrame, or ``base``/``name`` for ``read_or_convert``.
    ``csv_single`` writes the cleaned CSV as one part through one task (small
    tables only); by default the part folder is the CSV output.  ``exact`` /
    ``sketch`` choose the report's quantiles (see ``report_lines``).  ``charts``
    writes the chart inputs (see ``chart_tables``).  ``answers`` is a table of
    model response bodies (column ``body``): their texts are written too.
    ``multi_line=False`` reads a CSV without line breaks in its fields in
    parallel.
    """
    started = time.perf_counter()
    if raw is None:
        raw = read_or_convert(spark, base, name, multi_line=multi_line)
    cleaned_path = os.path.join(out_dir, "cleaned.parquet")
    write_table(clean_table(raw, spec), cleaned_path)
    if write_csv:
        write_table(read_table(spark, cleaned_path), os.path.join(out_dir, "cleaned_csv"),
                    fmt="csv", single=csv_single)
    calc_started = time.perf_counter()

    clean = read_table(spark, cleaned_path)
    # The report lines are a small table: written once, then both the text
    # report and the prompt are made from it without recomputing statistics.
    lines_path = os.path.join(out_dir, "report_lines.parquet")
    write_table(report_lines(clean, exact=exact, sketch=sketch), lines_path)
    lines = read_table(spark, lines_path)
    report_path = os.path.join(out_dir, "analysis_results")
    write_report(lines, report_path)
    requests = chat_requests(prompt_text(lines, DEFAULT_INSTRUCTIONS), model=model)
    request_path = os.path.join(out_dir, "chat_request")
    requests.write.mode("overwrite").json(request_path)
    outputs = {}
    if charts:
        tables = chart_tables(clean, exact=exact, sketch=sketch)
        for label, table in tables.items():
            path = os.path.join(out_dir, f"{label}.parquet")
            write_table(table, path)
            outputs[label] = path
    if answers is not None:
        outputs["answers"] = os.path.join(out_dir, "answers")
        write_answers(chat_content(answers, body=body), outputs["answers"])
    ended = time.perf_counter()
    return {
        **outputs,
        "cleaned": cleaned_path,
        "report_lines": lines_path,
        "report": report_path,
        "request": request_path,
        "total_sec": ended - started,
        "calc_sec": ended - calc_started,
    }


# Era cut (up to 2014 old, later new) and the price band of the
# box plot.
ERA_CUT = 2014
ERA_LABELS = ("old", "new")
BOX_PRICE_BAND = (0.0, 100.0)
# Hash key of the scatter sample (other columns break ties deterministically).
SAMPLE_KEY = ("name", "release_date")


def chart_tables(clean: DataFrame, exact: bool = False, sketch: str | None = None) -> dict:
    """The three chart inputs of the analysis, as DataFrames.

    * ``price_series``: year -> mean price, last 15 years with more than 30
      rows, null means dropped (bar chart);
    * ``scatter_sample`` / ``scatter_line`` / ``scatter_corr``: up to 5,000
      (critic, user) score pairs chosen by hash, 100 points of the line fitted
      to all pairs, and the correlation of all pairs with its wording; the
      first two only when there are more than 10 pairs (scatter chart);
    * ``era_box`` / ``era_stats``: box numbers and n / mean / median of
      prices in [0, 100] per era (box plot and its caption).
    """
    stats = group_stats(clean, order=False)
    pairs = clean.where(F.col("metacritic_score").isNotNull() & F.col("user_score").isNotNull())
    enough = corr_gated(pairs, "metacritic_score", "user_score").select(
        F.col("n") > MIN_PAIRS).scalar()
    sample = sample_n(pairs, list(SAMPLE_KEY), SAMPLE_ROWS).where(enough).select(
        "metacritic_score", "user_score")
    era = clean.withColumn("era", bucket(F.col("release_year"), [ERA_CUT], list(ERA_LABELS)))
    priced = band(era, "price", *BOX_PRICE_BAND, label="era")
    return {
        "price_series": series(stats, "release_year", "avg_price"),
        "scatter_sample": sample,
        "scatter_line": fit_line(pairs, "metacritic_score", "user_score"),
        "scatter_corr": corr_gated(pairs, "metacritic_score", "user_score").withColumn(
            "label", corr_label(F.col("corr"))),
        "era_box": box_stats(priced, "era", "price", exact=exact, sketch=sketch),
        "era_stats": bucket_stats(priced, "era", "price", exact=exact, sketch=sketch),
    }
