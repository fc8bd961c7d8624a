"""Headered CSV files -> cells, with per-file guards.

1. ``manifest``: one row per arrived object (``file_path``, ``length``, ...), from
   arrival events or a listing done by the executors.
2. ``read_headers``: the executors read the first record of each object, line ends in
   quoted fields included, and give its column names and width.
3. ``csv_blocks.read_rows``: every object is read in blocks of bytes, by as many tasks
   as it has blocks, decoded and split into records.  Paths stay in DataFrames: no
   file index sees them, so any object name and any number of header widths will do,
   and an object that cannot be read is a row, not a failed job.
4. Row-level guards ride in the aggregation of the cells (one pass): short rows, long
   rows, whether the first data row is long, and failures to read, decode or parse.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.derived import last_segment
from tessera.operators import profile as prof_ops
from tessera.session import shared_dir
from tessera.sources import csv_blocks as blocks_ops

# Status texts (the empty-file message is the reference's own).
MSG_EMPTY = "CSV file is empty or has no data rows"
MSG_UTF8 = "file is not valid UTF-8"
MSG_SHORT = "a row has fewer fields than the header"
MSG_LONG_FIRST = "the first row has more fields than the header"
MSG_UNREADABLE = "the object cannot be read"
MSG_HEADER = "the header line is not valid CSV"
MSG_ROW = "a row is not valid CSV"
FAILURES = {blocks_ops.UNREADABLE: MSG_UNREADABLE, blocks_ops.NOT_UTF8: MSG_UTF8, blocks_ops.NOT_CSV: MSG_ROW}

HEADER_SCHEMA = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("header_raw", T.StringType()),
    T.StructField("names", T.ArrayType(T.StringType())),
    T.StructField("src_ordinals", T.ArrayType(T.IntegerType())),
    T.StructField("width", T.IntegerType()),
    T.StructField("error", T.StringType()),
])


def _kept(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: used more than once, computed once."""
    path = shared_dir(spark, "csv", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# --------------------------------------------------------------------------
# Manifest
# --------------------------------------------------------------------------

def list_files(spark: SparkSession, root: str, suffix: str | None = ".csv") -> DataFrame:
    """Every file under ``root`` (empty files included), found level by level by the
    executors; what Spark's writers leave beside the data is left out.  Returns
    ``file_path, length, modification_ts``."""
    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["file_path"]:
                yield pd.DataFrame(blocks_ops.list_folder(path), columns=["file_path", "is_folder", "length", "mtime_ms"])

    found = []
    folders = spark.createDataFrame([(root,)], "file_path string")
    while True:
        level = folders.mapInPandas(fn, "file_path string, is_folder boolean, length long, mtime_ms long")
        level = _kept(spark, level, "listing")
        found.append(level.where("not is_folder"))
        folders = level.where("is_folder").select("file_path")
        n = folders.count()
        if not n:
            break
        folders = folders.repartition(min(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file_path")
    files = found[0]
    for level in found[1:]:
        files = files.unionByName(level)
    name = last_segment("file_path")
    files = files.where((name != "_SUCCESS") & ~(name.startswith(".") & name.endswith(".crc")))
    if suffix:
        files = files.where(name.endswith(suffix))
    return files.select("file_path", "length", F.timestamp_millis("mtime_ms").alias("modification_ts"))


# --------------------------------------------------------------------------
# Headers
# --------------------------------------------------------------------------

def parse_header(text: str, sep: str = ",", field_limit: int | None = None) -> tuple[list[str], list[int], int]:
    """Column names of a header record, with duplicate names resolved as the
    reference does: the last column of a name supplies the values, the first
    one fixes its position.  Returns (names, source ordinals, width)."""
    fields = next(blocks_ops.parse(text, sep, field_limit), [])
    last: dict[str, int] = {}
    for i, name in enumerate(fields, 1):
        last[name] = i
    names = list(dict.fromkeys(fields))
    return names, [last[name] for name in names], len(fields)


def read_headers(manifest: DataFrame, sep: str = ",", field_limit: int | None = None) -> DataFrame:
    """First record of every non-empty file, read by the executors."""
    def header(path: str):
        try:
            raw = blocks_ops.first_record(path, sep)
            text = raw.decode("utf-8")
        except OSError:
            return None, [], [], 0, MSG_UNREADABLE
        except UnicodeDecodeError:
            return raw.decode("utf-8", errors="replace"), [], [], 0, MSG_UTF8
        try:
            return text, *parse_header(text, sep, field_limit), None
        except csv.Error:
            return text, [], [], 0, MSG_HEADER

    def fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(p, n, *header(p)) for p, n in zip(pdf["file_path"], pdf["length"])]
            yield pd.DataFrame(rows, columns=HEADER_SCHEMA.fieldNames())

    files = manifest.where(F.col("length") > 0).select("file_path", "length", F.lit(0).alias("block"))
    return blocks_ops.spread(files).drop("block").mapInPandas(fn, HEADER_SCHEMA)


# --------------------------------------------------------------------------
# Profile of files
# --------------------------------------------------------------------------

def csv_cells(headers: DataFrame, sep: str = ",", block_bytes: int = blocks_ops.BLOCK_BYTES,
              field_limit: int | None = None) -> DataFrame:
    """The files of a header table as one cells DataFrame with positional columns;
    a failure is a cell of ordinal 0."""
    files = headers.where("width > 0 and error is null")
    rows = blocks_ops.read_rows(files, sep, block_bytes, field_limit)
    failed = F.col("failure").isNotNull()
    fields = F.when(failed, F.array(F.lit(None).cast("string"))).otherwise(F.col("fields"))
    cells = rows.select("file_path", "row_no", "is_short", "is_long", "failure", F.posexplode(fields).alias("pos", "value"))
    return cells.select("file_path", "row_no", "is_short", "is_long", "failure",
                        F.when(failed, F.lit(0)).otherwise(F.col("pos") + 1).alias("ordinal"), F.lit("").alias("column"), "value")


def profile_files(spark: SparkSession, manifest: DataFrame, sep: str = ",", block_bytes: int = blocks_ops.BLOCK_BYTES,
                  field_limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Profile every file of the manifest.

    Returns ``(columns, files)``: the column profile keyed by file_path with
    real header names (ordinal = header position), and one status row per
    manifest entry: file_path, file_name, status, error_message, row_count,
    n_short_rows, n_long_rows, long_first_row, utf8_ok.

    ``field_limit``: most characters of a field (the reference's CSV parser stops at
    131,072); None is no limit.  The column profile, one row per file column, is kept
    in the shared folder: both outputs use it.
    """
    # One row per object: a re-delivered notification must not read a file twice.
    manifest = manifest.groupBy("file_path").agg(F.max("length").alias("length"))
    headers = _kept(spark, read_headers(manifest, sep, field_limit), "headers")
    cells = csv_cells(headers, sep, block_bytes, field_limit)
    extra = [
        F.count_if("is_short").alias("n_short_rows"),
        F.count_if("is_long").alias("n_long_rows"),
        F.min_by("is_long", "row_no").alias("long_first_row"),
        F.min("failure").alias("failure"),
        F.count_if(F.col("failure") == blocks_ops.NOT_UTF8).alias("n_not_utf8"),
    ]
    prof = _kept(spark, prof_ops.column_profile(cells, ["file_path"], extra_aggs=extra), "columns")
    data = F.col("ordinal") > 0
    per_file = prof.groupBy("file_path").agg(
        F.max(F.when(data, F.col("n_rows"))).alias("row_count"), F.max("n_short_rows").alias("n_short_rows"),
        F.max("n_long_rows").alias("n_long_rows"), F.bool_or("long_first_row").alias("long_first_row"),
        F.min("failure").alias("failure"), F.sum("n_not_utf8").alias("n_not_utf8"))
    names = headers.select("file_path", F.posexplode(F.arrays_zip("names", "src_ordinals")).alias("pos", "h"))
    names = names.select("file_path", F.col("h.src_ordinals").alias("ordinal"),
                         (F.col("pos") + 1).alias("position"), F.col("h.names").alias("header_name"))
    columns = (prof.join(names, on=["file_path", "ordinal"], how="inner")
               .drop("column", "ordinal", "failure", "n_not_utf8")
               .withColumnRenamed("header_name", "column").withColumnRenamed("position", "ordinal"))
    return columns, file_status(manifest, per_file, headers)


def file_status(manifest: DataFrame, per_file: DataFrame, headers: DataFrame) -> DataFrame:
    """Status and error message per manifest entry.

    Precedence: an object that cannot be read, undecodable bytes anywhere, a header or
    row that is no CSV, no data rows, a short row anywhere, an over-long first row.
    Long later rows are tolerated and counted.
    """
    m = manifest.select("file_path", "length").join(per_file, "file_path", "left")
    m = m.join(headers.where("error is not null").select("file_path", F.col("error").alias("header_error")), "file_path", "left")
    rows = F.coalesce(F.col("row_count"), F.lit(0))
    err = F.col("header_error")
    for kind, text in FAILURES.items():
        err = F.coalesce(err, F.when(F.col("failure") == kind, F.lit(text)))
    err = (F.when(err.isNotNull(), err)
           .when(rows == 0, F.lit(MSG_EMPTY))
           .when(F.coalesce(F.col("n_short_rows"), F.lit(0)) > 0, F.lit(MSG_SHORT))
           .when(F.coalesce(F.col("long_first_row"), F.lit(False)), F.lit(MSG_LONG_FIRST)))
    return m.select(
        "file_path", last_segment("file_path").alias("file_name"),
        F.when(err.isNull(), F.lit("success")).otherwise(F.lit("error")).alias("status"),
        err.alias("error_message"),
        F.when(err.isNull(), rows).otherwise(F.lit(0)).cast("bigint").alias("row_count"),
        F.coalesce(F.col("n_short_rows"), F.lit(0)).alias("n_short_rows"),
        F.coalesce(F.col("n_long_rows"), F.lit(0)).alias("n_long_rows"),
        F.coalesce(F.col("long_first_row"), F.lit(False)).alias("long_first_row"),
        ((F.coalesce(F.col("n_not_utf8"), F.lit(0)) == 0) & ~F.col("header_error").eqNullSafe(F.lit(MSG_UTF8))).alias("utf8_ok"),
    )


def successful_columns(columns: DataFrame, files: DataFrame) -> DataFrame:
    """Column profiles of files whose status is success (errors carry none)."""
    ok = files.where(F.col("status") == "success").select("file_path")
    return columns.join(ok, "file_path", "left_semi")


__all__ = ["list_files", "read_headers", "parse_header", "csv_cells", "profile_files", "file_status", "successful_columns"]
