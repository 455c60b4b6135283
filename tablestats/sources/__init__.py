"""Sources and sinks: CSV / Parquet scans, the Parquet copy, writers."""

from tablestats.sources.io import read_or_convert, read_table, write_report, write_table

__all__ = ["read_or_convert", "read_table", "write_report", "write_table"]
