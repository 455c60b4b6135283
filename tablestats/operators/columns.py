"""Projection and column derivation: DataFrame -> DataFrame.

Every function adds or replaces columns with built-in expressions only, so a
chain of them collapses into one Project over the scan (Catalyst
``CollapseProject``) and the scan reads only the referenced columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablestats.functions.clean import ISO_DATE, clean_numeric_col, finite_number, parse_date, to_number

# The catalogue columns the analysis uses, in table order, and
# the names of the derived columns.
CATALOG_COLUMNS = (
    "name",
    "price",
    "user_score",
    "metacritic_score",
    "positive",
    "negative",
    "pct_pos_total",
    "categories",
    "genres",
    "tags",
    "release_date",
)
MESSY_NUMBER_COLUMNS = ("price", "user_score", "metacritic_score")
COUNT_COLUMNS = ("positive", "negative")
YEAR_COLUMN = "release_year"
TOTAL_COLUMN = "total_reviews"
RATIO_COLUMN = "positive_ratio"

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def _is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, _NUMERIC)


def select_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order (tolerant mode)."""
    present = set(df.columns)
    return df.select([c for c in wanted if c in present])


def clean_numeric(df: DataFrame, cols: Sequence[str], reparse: bool = False) -> DataFrame:
    """Strict number cleaning of text columns (see ``clean_numeric_col``).

    Columns that are already numeric pass through as double (NaN and infinities
    as null, as in text) unless
    ``reparse`` is set, in which case their text form is cleaned too (the
    sign is lost, as for text).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for c in cols:
        if _is_numeric(types[c]) and not reparse:
            out[c] = _number(F.col(c), types[c])
        else:
            out[c] = clean_numeric_col(F.col(c))
    return df.withColumns(out)


def add_year(df: DataFrame, date_col: str = "release_date", out: str = YEAR_COLUMN) -> DataFrame:
    """Calendar year (int) of a date or timestamp column; null stays null."""
    return df.withColumn(out, F.year(F.col(date_col)).cast("int"))


def add_total(df: DataFrame, a: str = "positive", b: str = "negative",
              out: str = TOTAL_COLUMN, strict: bool = True) -> DataFrame:
    """``a + b`` as long; null where an input or the sum is no long.  With ``strict=False`` a missing input leaves df as is."""
    if not strict and not (a in df.columns and b in df.columns):
        return df
    return df.withColumn(out, F.try_add(F.col(a).try_cast("long"), F.col(b).try_cast("long")))


def add_ratio(df: DataFrame, part: str = "positive", total: str = TOTAL_COLUMN,
              out: str = RATIO_COLUMN, scale: float = 100.0) -> DataFrame:
    """Guarded share ``part / total * scale``; null when total is 0 or null."""
    t = F.col(total)
    share = F.col(part).cast("double") / t.cast("double") * F.lit(scale)
    return df.withColumn(out, F.when(t > 0, share))


def _number(c: Column, dt: T.DataType, finite: bool = True) -> Column:
    """A numeric column as double; only floats can hold NaN and infinities."""
    return finite_number(c) if finite and isinstance(dt, (T.FloatType, T.DoubleType)) else c.cast("double")


def _cleaned(name: str, c: Column, dt: T.DataType, date_formats: Sequence[str],
             numbers: str, finite: bool) -> Column:
    if name in MESSY_NUMBER_COLUMNS:
        if _is_numeric(dt):
            return _number(c, dt, finite)
        return clean_numeric_col(c) if numbers == "strip" else to_number(c)
    if name in COUNT_COLUMNS:
        return (c if _is_numeric(dt) else to_number(c)).try_cast("long")
    if name == "pct_pos_total":
        return _number(c, dt, finite) if _is_numeric(dt) else to_number(c)
    if name == "release_date":
        if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return c.cast("date")
        return parse_date(c, date_formats)
    return c.cast("string")


def clean_table(df: DataFrame, spec: Mapping[str, str | Column] | None = None,
                date_formats: Sequence[str] | str = (ISO_DATE,),
                numbers: str = "strip", derive: bool = True, finite: bool = True) -> DataFrame:
    """Project the 11 catalogue columns, clean them, derive three more.

    ``spec`` maps each catalogue column to a source column name or a Column
    expression (default: same names).  Result (14 columns): name, price,
    user_score, metacritic_score, positive, negative, pct_pos_total,
    categories, genres, tags, release_date, release_year, total_reviews,
    positive_ratio.  ``numbers='strip'`` is the strict text cleaning,
    ``'coerce'`` the signed parse.  NaN and infinities of float columns become
    null, as text without a number does; ``finite=False`` says that the source holds
    none, and filters on such columns then reach its reader (they always reach a
    stored cleaned table's).  All of it is one Project over the scan.
    """
    spec = dict(spec) if spec else {c: c for c in CATALOG_COLUMNS}
    missing = [c for c in CATALOG_COLUMNS if c not in spec]
    if missing:
        raise ValueError(f"clean_table spec lacks {missing}")
    projected = df.select([
        (F.col(src) if isinstance(src, str) else src).alias(name)
        for name, src in ((c, spec[c]) for c in CATALOG_COLUMNS)
    ])
    types = {f.name: f.dataType for f in projected.schema.fields}
    fmts = (date_formats,) if isinstance(date_formats, str) else tuple(date_formats)
    out = projected.select([
        _cleaned(c, F.col(c), types[c], fmts, numbers, finite).alias(c) for c in CATALOG_COLUMNS
    ])
    if not derive:
        return out
    out = add_year(out, "release_date", YEAR_COLUMN)
    out = add_total(out, "positive", "negative", TOTAL_COLUMN)
    return add_ratio(out, "positive", TOTAL_COLUMN, RATIO_COLUMN)
