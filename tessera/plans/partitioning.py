"""Partitioning helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_CELLS = 1 << 18    # a task of fewer cells takes about a second: not worth a shuffle
TASK_CELLS = 1 << 23     # cells of a partition, where rows are spread


def even_parts(df: DataFrame, id_cols: Sequence[str], value_cols: Sequence[str]) -> tuple[DataFrame, list[list[str]]]:
    """(rows, groups of the value columns) for CPU-heavy work on every cell alone: each
    group is to be read by itself.  An input that arrives evenly is one group.

    Where one partition holds more than twice its share of the rows (one small file, one
    parquet row group, however many splits its file has), there are as many groups as it
    takes for no partition of a group to hold over twice its share of all cells: a
    columnar file is read once all the same, and no row moves.  Rows are spread, hash-
    partitioned on ``id_cols``, which must identify a row, only if single columns do not
    even it out: deterministic under task retries and free of skew.

    The rows of each partition are counted first: of a scan that takes the files'
    footers alone, no column is read."""
    target, width = df.sparkSession.sparkContext.defaultParallelism, len(value_cols)
    sizes = df.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    largest, total = sizes.agg(F.max("n"), F.sum("n")).first()
    size = group_width(largest or 0, total or 0, target, width)
    if not size:
        df, size = df.repartition(max(target, -(-total * width // TASK_CELLS)), *id_cols), width
    return df, [list(value_cols[i:i + size]) for i in range(0, width, size)]


def group_width(largest: int, total: int, target: int, width: int) -> int:
    """The most of ``width`` columns of which a partition of ``largest`` rows, of ``total``,
    holds at most ``LEAST_CELLS`` cells or twice a share of all cells, ``target`` being
    the number of shares; 0 if one column is too much."""
    for size in range(width, 0, -1):
        if largest * size <= LEAST_CELLS or largest * size * target <= 2 * total * width:
            return size
    return 0
