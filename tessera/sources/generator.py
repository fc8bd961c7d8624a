"""Deterministic employee rows (S7), one generated file per id, as expressions.

Row i of file f: name Employee_f_i, age 25 + i % 40, salary
50000 + (i * 1000) % 100000, join date 202{i%5}-{i%12+1:02}-{i%28+1:02},
department and city by i % 5, employee id EMP{f:04}{i:04}.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values (list order matters: index = i % 5).
DEPARTMENTS = ["Engineering", "Sales", "Marketing", "HR", "Finance"]
CITIES = ["New York", "San Francisco", "London", "Tokyo", "Berlin"]
HEADER = ["name", "age", "salary", "join_date", "department", "city", "employee_id"]


def employees(ids: DataFrame, file_col: str = "file_id", row_col: str = "i") -> DataFrame:
    """Generate one employee row per (file id, row index) pair of ``ids``."""
    f, i = F.col(file_col), F.col(row_col)
    pick = lambda arr: F.element_at(F.array(*[F.lit(x) for x in arr]), (i % 5 + 1).cast("int"))
    return ids.select(
        f.alias("file_id"), i.alias("i"),
        F.format_string("Employee_%d_%d", f, i).alias("name"),
        (F.lit(25) + i % 40).cast("string").alias("age"),
        (F.lit(50000) + (i * 1000) % 100000).cast("string").alias("salary"),
        F.format_string("202%d-%02d-%02d", i % 5, i % 12 + 1, i % 28 + 1).alias("join_date"),
        pick(DEPARTMENTS).alias("department"),
        pick(CITIES).alias("city"),
        F.format_string("EMP%04d%04d", f, i).alias("employee_id"),
    )


def employee_csv_lines(emps: DataFrame) -> DataFrame:
    """The generated rows as CSV text lines (comma-joined, no quoting needed)."""
    return emps.select("file_id", "i", F.concat_ws(",", *HEADER).alias("line"))
