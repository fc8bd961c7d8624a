"""Rounding with Python's semantics, as built-in double arithmetic.

Python's ``round(x, n)`` (and ``f"{x:.nf}"``) rounds the *exact binary value*
of a double half-to-even: ``round(2.675, 2) == 2.67`` because 2.675 is stored
as 2.67499999...; Spark's ``round`` works on the shortest decimal text and
gives 2.68.  To reproduce the reference exactly, the product ``x * 10^n`` is
computed together with its exact rounding error (Dekker's error-free product,
only +, -, * on doubles), which says on which side of a decimal tie the true
value lies.  The same arithmetic is written as SQL for the DuckDB oracle, so
both engines produce identical doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPLITTER = 134217729.0  # fixed value: 2^27 + 1, Veltkamp split constant for doubles
EXACT_LIMIT = 4503599627370496.0  # 2^52: beyond it every double is an integer


def py_round(col, n: int) -> Column:
    """round(x, n) exactly as Python computes it (n >= 0).

    Given a column name the expression is built in one SQL call; given a
    Column it is assembled from Column operations (same arithmetic).
    """
    if isinstance(col, str):
        return F.expr(py_round_sql(f"`{col}`", n, dialect="spark"))
    x = col.cast("double")
    s = float(10 ** n)
    r = x * F.lit(s)
    c = x * F.lit(SPLITTER)
    hi = c - (c - x)
    lo = x - hi
    err = (hi * F.lit(s) - r) + lo * F.lit(s)
    k = F.floor(r)
    frac = r - k
    up = (frac > 0.5) | ((frac == 0.5) & ((err > 0) | ((err == 0) & (k % 2 != 0))))
    res = (k + up.cast("bigint")) / F.lit(s)
    return F.when(x.isNull() | F.isnan(x) | (F.abs(r) >= F.lit(EXACT_LIMIT)), x).otherwise(res)


def py_round_sql(expr: str, n: int, dialect: str = "duckdb") -> str:
    """The same computation as a SQL expression (``duckdb`` or ``spark``)."""
    def lit(v: float) -> str:
        return f"{v!r}D" if dialect == "spark" else f"CAST({v!r} AS DOUBLE)"
    s = lit(float(10 ** n))
    x = f"CAST(({expr}) AS DOUBLE)"
    r = f"({x} * {s})"
    c = f"({x} * {lit(SPLITTER)})"
    hi = f"({c} - ({c} - {x}))"
    lo = f"({x} - {hi})"
    err = f"((({hi} * {s}) - {r}) + ({lo} * {s}))"
    k = f"floor({r})"
    frac = f"({r} - {k})"
    half = lit(0.5)
    zero = lit(0.0)
    up = f"({frac} > {half} OR ({frac} = {half} AND ({err} > {zero} OR ({err} = {zero} AND {k} % 2 <> 0))))"
    return (f"(CASE WHEN {x} IS NULL OR isnan({x}) OR abs({r}) >= {lit(EXACT_LIMIT)} THEN {x} "
            f"ELSE ({k} + CASE WHEN {up} THEN 1 ELSE 0 END) / {s} END)")
