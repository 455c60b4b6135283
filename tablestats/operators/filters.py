"""Row filters.  Plain predicates on typed columns reach the Parquet reader
(``PushedFilters``); predicates on computed columns are evaluated right after
the scan inside the same code-generated stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def band(df: DataFrame, col: str, lo: float | None = None, hi: float | None = None,
         lo_open: bool = False, hi_open: bool = False, label: str | None = None) -> DataFrame:
    """Keep rows whose ``col`` is non-null (and not NaN) and inside [lo, hi].

    ``lo_open`` / ``hi_open`` make the bound strict (``lo_open=True, lo=0`` is
    "positive only"); ``label`` additionally requires a non-null label column.
    """
    x = F.col(col)
    cond = x.isNotNull()
    if hi is None and dict(df.dtypes).get(col) in ("double", "float"):
        cond = cond & ~F.isnan(x)  # NaN sorts above every number
    if lo is not None:
        cond = cond & ((x > lo) if lo_open else (x >= lo))
    if hi is not None:
        cond = cond & ((x < hi) if hi_open else (x <= hi))
    if label is not None:
        cond = cond & F.col(label).isNotNull()
    return df.where(cond)


def drop_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``cols``."""
    return df.dropna(how="any", subset=list(cols))
