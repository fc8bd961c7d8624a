"""Writers (K1, K4, K5, K6) and the read-back of summaries."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import local_path, pyarrow_filesystem


def write_summaries(docs: DataFrame, out_dir: str, exact_names: bool = False) -> None:
    """K1: one summary document per file.

    Default: a JSON-lines dataset with ``summary_key`` kept as a column (the
    Spark writer chooses object names).  ``exact_names=True`` writes every
    document to ``out_dir/<summary_key>`` from the executors, for consumers
    that fetch by key.  A document appears under its name whole or not at all,
    however many attempts of a task write it or are killed.
    """
    if not exact_names:
        docs.write.mode("append").json(out_dir)
        return
    base = out_dir.rstrip("/")
    texts = docs.select("summary_key", F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"}).alias("text"))

    def write_part(rows):
        for r in rows:
            put_object(f"{base}/{r['summary_key']}", json.dumps(json.loads(r["text"]), indent=2).encode("utf-8"))

    texts.foreachPartition(write_part)


def put_object(target: str, data: bytes) -> None:
    """Write an object whole: beside its name first, then renamed, which replaces an
    older one in one step.  Stores without renames keep an object unseen until it is
    closed, and there it is written by one call."""
    if "://" in target and not target.startswith("file:"):
        filesystem, path = pyarrow_filesystem(target)
        if filesystem.type_name in ("s3", "gcs", "abfs"):
            with filesystem.open_output_stream(path) as f:
                f.write(data)
            return
        folder, _, name = path.rpartition("/")
        filesystem.create_dir(folder, recursive=True)
        part = f"{folder}/.{name}.{uuid.uuid4().hex}"
        with filesystem.open_output_stream(part) as f:
            f.write(data)
        filesystem.move(part, path)
        return
    path = local_path(target)
    folder, name = os.path.split(path)
    os.makedirs(folder, exist_ok=True)
    part = os.path.join(folder, f".{name}.{uuid.uuid4().hex}")
    try:
        with open(part, "wb") as f:
            f.write(data)
        os.replace(part, path)
    except BaseException:
        if os.path.exists(part):
            os.remove(part)
        raise


def read_summaries(spark: SparkSession, out_dir: str, schema=None) -> DataFrame:
    """Read summary documents back (JSON lines written by write_summaries)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(out_dir)


def _decimal_of(value: Column, dtype: T.DataType, scale: int) -> Column:
    """The value with every floating leaf a decimal; nulls stay null at every level."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        # By way of the shortest text that gives the number, as a JSON round trip does.
        return value.cast("string").try_cast(T.DecimalType(38, scale))
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _decimal_of(x, dtype.elementType, scale))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value, lambda _, x: _decimal_of(x, dtype.valueType, scale))
    if isinstance(dtype, T.StructType):
        fields = [_decimal_of(value[f.name], f.dataType, scale).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def to_decimal_leaves(df: DataFrame, cols: list[str] | None = None, scale: int = 18) -> DataFrame:
    """K4: exact decimal copies of the float leaves of ``cols`` (all columns by default),
    at any depth of arrays, map values and structs, for a decimal-typed sink.  NaN,
    infinities and numbers of more digits than a decimal holds become NULL."""
    return df.select(*[_decimal_of(F.col(f"`{f.name}`"), f.dataType, scale).alias(f.name)
                       if cols is None or f.name in cols else F.col(f"`{f.name}`") for f in df.schema.fields])


def write_results(df: DataFrame, out_dir: str, partition_cols: tuple[str, ...] = ("environment",)) -> None:
    """K5: run results as JSON, partitioned by environment."""
    df.write.mode("append").partitionBy(*partition_cols).json(out_dir)


def write_report(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> None:
    """K6: every comparison table of a report under out_dir/<name>."""
    for name, df in tables.items():
        df.write.mode("overwrite").format(fmt).save(f"{out_dir.rstrip('/')}/{name}")
