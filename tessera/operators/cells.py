"""Wide -> long: the ``cells`` form ``(keys..., row_no, ordinal, column, value)``.

``DataFrame.unpivot`` plans as a single ``Expand`` inside the scan's codegen
stage, so turning N columns into N cells costs no shuffle; everything
downstream is one hash aggregation keyed by (file, ordinal).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.partitioning import even_parts


def to_cells(df: DataFrame, id_cols: Sequence[str] = ("file_name", "row_no"),
             value_cols: Sequence[str] | None = None, start_ordinal: int = 1,
             spread: bool = True) -> DataFrame:
    """Unpivot ``value_cols`` (default: all non-id columns) into text cells.

    ``ordinal`` is the 1-based position of the column in ``value_cols`` (the
    header order), ``column`` its name and ``value`` the cell as text.  With
    ``spread`` an input whose rows lie in few partitions is read by groups of its
    columns, or if these do not even it out hash-partitioned on the id columns, which
    must identify a row (see ``even_parts``).
    """
    id_cols = list(id_cols)
    if value_cols is None:
        value_cols = [c for c in df.columns if c not in id_cols]
    cells = {
        c: F.struct(F.lit(i).alias("ordinal"), F.col(f"`{c}`").cast("string").alias("value")).alias(c)
        for i, c in enumerate(value_cols, start_ordinal)
    }
    df, groups = even_parts(df, id_cols, value_cols) if spread else (df, [list(value_cols)])
    long = reduce(DataFrame.unionByName, [df.unpivot(id_cols, [cells[c] for c in g], "column", "cell") for g in groups])
    return long.select(*id_cols, F.col("cell.ordinal").alias("ordinal"), "column",
                       F.col("cell.value").alias("value"))


def ordered_rows(df: DataFrame, name: str = "row_no") -> DataFrame:
    """``df`` read from files, with a row number that follows (path, position in the
    file).  Files are numbered in path order; their table, one thin row per file, is
    joined only if there are several, and broadcast: the rows stay where they are read."""
    at = F.col("_metadata.row_index")
    if len(df.inputFiles()) <= 1:
        return df.withColumn(name, at)
    paths = df.select(F.col("_metadata.file_path").alias("_path")).distinct()
    paths = paths.withColumn("_file", F.row_number().over(Window.orderBy("_path")).cast("bigint"))
    rows = df.select("*", F.col("_metadata.file_path").alias("_path"), at.alias("_at")).join(F.broadcast(paths), "_path")
    return rows.withColumn(name, F.col("_file") * (1 << 40) + F.col("_at")).drop("_path", "_file", "_at")
