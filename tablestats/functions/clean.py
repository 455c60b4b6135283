"""Scalar cleaning expressions.

All of these are built-in Spark expressions, so they stay inside whole-stage
code generation and work unchanged on batch and streaming DataFrames.  Every
conversion uses the ``try_`` form: Spark's ANSI mode raises on bad text, but
messy catalogue text must turn into null, never fail the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The strict cleaning keeps digits and dots only, and the strict
# date pattern is ISO year-month-day.
NON_NUMERIC_CHARS = r"[^0-9.]"
ISO_DATE = "yyyy-MM-dd"

# A plain decimal number, optionally signed, with an optional exponent.  Used
# by ``to_number`` so that text such as 'NaN', 'Infinity' or '5d', which a
# bare cast to double would accept, stays null.
PLAIN_NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

# Patterns tried in order by the lenient date parse (first that parses wins),
# each with the shape a text must have for the pattern to be tried at all: a
# failing parse costs far more than a failing match.
_DATE_SHAPES = {
    "yyyy-MM-dd": r"^[+]?\d{4,}-\d\d-\d\d$",
    "yyyy-M-d": r"^[+]?\d{4,}-\d+-\d+$",
    "yyyy/M/d": r"^[+]?\d{4,}/\d+/\d+$",
    "yyyy-MM-dd HH:mm:ss": r"^[+]?\d{4,}-\d\d-\d\d \d",
    "yyyy-MM-dd'T'HH:mm:ss": r"^[+]?\d{4,}-\d\d-\d\d[Tt]\d",
    "MMM d, yyyy": r"^\D{3} \d+, [+]?\d{4,}$",
    "MMMM d, yyyy": r"^\D{3,} \d+, [+]?\d{4,}$",
    "d MMM, yyyy": r"^\d+ \D{3}, [+]?\d{4,}$",
    "d MMM yyyy": r"^\d+ \D{3} [+]?\d{4,}$",
    "M/d/yyyy": r"^\d+/\d+/[+]?\d{4,}$",
}
LENIENT_DATE_FORMATS = tuple(_DATE_SHAPES)


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def known(c: Column | str) -> Column:
    """NaN as null (a double column)."""
    v = _as_col(c)
    return F.when(~F.isnan(v), v)


def _finite(c: Column) -> Column:
    """NaN and infinities (text beyond the range of doubles) as null."""
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def finite_number(c: Column | str) -> Column:
    """A numeric column as double, as if its text were cleaned: NaN and infinities become null, the sign stays."""
    return _finite(_as_col(c).cast("double"))


def clean_numeric_col(c: Column | str) -> Column:
    """Strip every character but digits and dots, then cast to double.

    '$9.99' -> 9.99, '1,299.50' -> 1299.5, '12.5%' -> 12.5.  The sign and an
    exponent are dropped with the other characters ('-3' -> 3.0), exactly as
    the strict cleaning rule does; text left without a valid number ('Free',
    '.', '1.2.3', '') or with one beyond the range of doubles becomes null.
    """
    text = _as_col(c).cast("string")
    return _finite(F.regexp_replace(text, NON_NUMERIC_CHARS, "").try_cast("double"))


def to_number(c: Column | str) -> Column:
    """Coercing conversion: a plain (signed) number, anything else -> null.

    '9.99' -> 9.99, '-3' -> -3.0, '1e7' -> 1e7; '$9.99', '1,299.50',
    '12.5%', 'Free', 'NaN', '1e999' -> null.
    """
    text = _as_col(c).cast("string")
    return F.when(text.rlike(PLAIN_NUMBER), _finite(text.try_cast("double")))


def parse_date(c: Column | str, fmts: Sequence[str] | str = (ISO_DATE,)) -> Column:
    """Parse text to a date with the first pattern that matches, else null.

    With the default single ISO pattern this is the strict parse
    ('2024-1-5', 'Jan 5, 2024', '2024-02-30' and text with a time part are
    null); pass ``LENIENT_DATE_FORMATS`` for the coercing parse.  Meant for
    text: a date or timestamp column only needs ``cast('date')``, which
    ``clean_table`` applies by type.
    """
    if isinstance(fmts, str):
        fmts = (fmts,)
    text = _as_col(c).cast("string")
    if len(fmts) == 1:
        return F.try_to_date(text, fmts[0])
    return F.coalesce(*[F.when(text.rlike(_DATE_SHAPES[f]), F.try_to_date(text, f)) if f in _DATE_SHAPES
                        else F.try_to_date(text, f) for f in fmts])


def bucket(c: Column | str, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins: label[i] for cuts[i-1] < v <= cuts[i]; null and NaN give null.

    ``len(labels) == len(cuts) + 1``; the last label takes every value above
    the last cut, so the expression never raises whatever the data range.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("bucket needs exactly one label more than cuts")
    v = _as_col(c)
    expr = F.when(F.isnan(v.cast("double")), F.lit(None)).when(v <= F.lit(cuts[0]), F.lit(labels[0]))
    for cut, label in zip(cuts[1:], labels[1:-1]):
        expr = expr.when(v <= F.lit(cut), F.lit(label))
    return expr.when(v > F.lit(cuts[-1]), F.lit(labels[-1]))
