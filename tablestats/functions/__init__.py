"""Column -> Column helpers: number and date cleaning, buckets, labels."""

from tablestats.functions.clean import (
    LENIENT_DATE_FORMATS,
    bucket,
    clean_numeric_col,
    parse_date,
    to_number,
)
from tablestats.functions.labels import corr_label

__all__ = [
    "LENIENT_DATE_FORMATS",
    "bucket",
    "clean_numeric_col",
    "corr_label",
    "parse_date",
    "to_number",
]
