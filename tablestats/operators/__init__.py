"""DataFrame -> DataFrame operators."""

from tablestats.operators.columns import (
    add_ratio,
    add_total,
    add_year,
    clean_numeric,
    clean_table,
    select_existing,
)
from tablestats.operators.filters import band, drop_nulls
from tablestats.operators.groups import count_by, group_stats, last_n, peak, per_key, series, span
from tablestats.operators.profile import center, column_profile, robust_summary, shape, summary
from tablestats.operators.quantiles import approx_quantiles, exact_quantiles
from tablestats.operators.relate import corr_gated, fit_line, linear_fit, predict, sample_n
from tablestats.operators.spread import box_stats, bucket_stats

__all__ = [
    "add_ratio", "add_total", "add_year", "approx_quantiles", "band", "box_stats",
    "bucket_stats", "center", "exact_quantiles",
    "clean_numeric", "clean_table", "column_profile", "corr_gated", "count_by", "drop_nulls",
    "fit_line", "group_stats", "last_n", "linear_fit", "peak", "per_key", "predict",
    "robust_summary", "sample_n", "select_existing", "series", "shape", "span", "summary",
]
