"""Small derived-column helpers (P1, P2, P6, P7, P10, S6 path handling)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.rounding import py_round


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def last_segment(col) -> Column:
    """File name = last '/'-separated segment of a key or path."""
    return F.element_at(F.split(_c(col), "/"), -1)


def summary_key(file_name) -> Column:
    """processed/<name with every '.csv' removed>_summary.json."""
    return F.concat(F.lit("processed/"), F.replace(_c(file_name), F.lit(".csv"), F.lit("")),
                    F.lit("_summary.json"))


def iso_utc(ts) -> Column:
    """ISO-8601 UTC text with a 'Z' suffix."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def truncate(col, n: int) -> Column:
    """First n characters of an error text."""
    return F.left(_c(col), F.lit(n))


def size_kb(length) -> Column:
    """P10: size in KB, 1 decimal."""
    return py_round(_c(length) / 1024, 1)
