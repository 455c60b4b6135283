"""Command line: run the whole catalogue analysis as one Spark application.

    python -m tablestats ...
    spark-submit --py-files tablestats.zip tablestats/__main__.py ...   (on a cluster)

    --input PATH          a .csv or Parquet table, read directly
    --base DIR --name N   DIR/N.parquet if present, else DIR/N.csv converted once
    --out DIR             output folder (shared storage on a cluster)
    --map COL=SQL         source of a catalogue column as a SQL expression
                          (repeatable; unmapped columns use their own name)
    --exact               exact quartiles and medians
    --sketch gk|kll       sketch kind for approximate quantiles (default: by size)
    --csv-single          write the cleaned CSV as one part (small tables only)
    --no-csv              skip the cleaned CSV copy

Prints the output paths and the two run times (everything; calculations
after the sinks) as JSON.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tablestats.operators.columns import CATALOG_COLUMNS
from tablestats.plans.job import analyze
from tablestats.sources.io import read_table


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tablestats", description="Catalogue analysis on Spark")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--input")
    src.add_argument("--base")
    p.add_argument("--name")
    p.add_argument("--out", required=True)
    p.add_argument("--map", action="append", default=[], metavar="COL=SQL")
    p.add_argument("--exact", action="store_true")
    p.add_argument("--sketch", choices=("gk", "kll"))
    p.add_argument("--csv-single", action="store_true")
    p.add_argument("--no-csv", action="store_true")
    p.add_argument("--single-line", action="store_true",
                   help="no CSV field holds a line break: read large files in parallel")
    args = p.parse_args(argv)
    if args.base and not args.name:
        p.error("--base needs --name")
    return args


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    spark = spark or SparkSession.builder.appName("tablestats").getOrCreate()
    raw = read_table(spark, args.input, multi_line=not args.single_line) if args.input else None
    spec = None
    if args.map:
        spec = {c: c for c in CATALOG_COLUMNS}
        for item in args.map:
            col, _, sql = item.partition("=")
            if col not in spec or not sql:
                raise SystemExit(f"--map needs COL=SQL with COL in {', '.join(CATALOG_COLUMNS)}")
            spec[col] = F.expr(sql)
    result = analyze(spark, args.out, raw=raw, base=args.base, name=args.name, spec=spec,
                     exact=args.exact, sketch=args.sketch, write_csv=not args.no_csv,
                     csv_single=args.csv_single, multi_line=not args.single_line)
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
