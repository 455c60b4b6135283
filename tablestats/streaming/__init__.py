"""Streaming.

The analysis has no stream source, watermark, window or state.  The cleaning
operators (``clean_table``, ``clean_numeric``, ``parse_date``, ``bucket``,
``band``, ``add_*``) are stateless column expressions and apply unchanged to a
streaming DataFrame from ``spark.readStream``; nothing else is provided here.
"""
