"""tablestats: descriptive analytics of catalogue-like tables on Spark.

Every public function takes and returns Spark DataFrames or Columns built from
built-in expressions; exact quantiles, samples and converted copies run jobs of
their own while they are built.
"""

from tablestats.functions import bucket, clean_numeric_col, corr_label, parse_date, to_number
from tablestats.operators import *  # noqa: F401,F403
from tablestats.operators import __all__ as _ops
from tablestats.plans import chat_content, chat_requests, prompt_text, report_lines, summary_lines
from tablestats.sources import read_or_convert, read_table, write_report, write_table

__all__ = [
    *_ops, "bucket", "chat_content", "chat_requests", "clean_numeric_col", "corr_label",
    "parse_date", "prompt_text", "read_or_convert", "read_table", "report_lines",
    "summary_lines", "to_number", "write_report", "write_table",
]
