"""The metadata log as a table of files.

Every micro-batch of a source has a folder of its own, written whole: a redelivered
batch replaces its folder, so that (source, batch, file) occurs once.  ``compact`` folds
the log into one record per key, sorted by key into files; readers take the newest
finished fold and the batches after it.  A fold that was interrupted has no success
mark and is passed over.

    <path>/log/source=<name>/batch_id=<n>/    records as they came
    <path>/base/<n>/rows/                     newest record per key, sorted by key
    <path>/base/<n>/covered/                  source, upto: the batches folded in
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.ranking import latest_per_key

ORDER = ("processed_ts", "seq", "batch_id", "source")
LISTED = 200            # probe keys that are named in the filter of a scan


def append(records: DataFrame, path: str, batch_id: int, source: str = "main") -> None:
    """K2/R2: the records of one batch.  Schemas may gain columns from batch to batch."""
    records.write.mode("overwrite").parquet(f"{path.rstrip('/')}/log/source={source}/batch_id={int(batch_id)}")


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if it is not there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []


def _finished(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _newest_base(spark: SparkSession, path: str) -> str | None:
    numbers = sorted((int(n) for n in _folders(spark, f"{path}/base") if n.isdigit()), reverse=True)
    return next((f"{path}/base/{n}" for n in numbers if _finished(spark, f"{path}/base/{n}/covered")), None)


def read_parts(spark: SparkSession, path: str) -> list[DataFrame]:
    """The newest fold, if any, and the log's batches after it, with ``source`` and ``batch_id``."""
    path = path.rstrip("/")
    base = _newest_base(spark, path)
    parts = []
    fresh = F.lit(True)
    if base is not None:
        parts.append(spark.read.parquet(f"{base}/rows"))
        # One row per source; the filter is on folder names, so that no covered file is opened.
        for r in spark.read.parquet(f"{base}/covered").collect():
            fresh = fresh & ~((F.col("source") == r["source"]) & (F.col("batch_id") <= r["upto"]))
    if _folders(spark, f"{path}/log"):
        log = spark.read.option("mergeSchema", True).option("basePath", f"{path}/log").parquet(f"{path}/log")
        log = log.withColumn("source", F.col("source").cast("string")).withColumn("batch_id", F.col("batch_id").cast("bigint"))
        parts.append(log.where(fresh))
    return parts


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def _latest(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    return latest_per_key(rows, list(key), [c for c in ORDER if c in rows.columns])


def current(spark: SparkSession, path: str, key: Sequence[str] = ("file_name",)) -> DataFrame:
    """The newest record per key."""
    return _latest(_union(read_parts(spark, path)), key)


def compact(spark: SparkSession, path: str, key: Sequence[str] = ("file_name",)) -> None:
    """Folds all batches that are there into a new base; what was there stays."""
    path = path.rstrip("/")
    seen = []
    for source in _folders(spark, f"{path}/log"):
        batches = [int(b.split("=", 1)[1]) for b in _folders(spark, f"{path}/log/{source}")]
        if batches:
            seen.append((source.split("=", 1)[1], max(batches)))
    number = max((int(n) for n in _folders(spark, f"{path}/base") if n.isdigit()), default=-1) + 1
    rows = current(spark, path, key)
    for source, upto in seen:           # a batch that arrived meanwhile is left to the log
        rows = rows.where((F.col("source") != source) | (F.col("batch_id") <= upto))
    rows.repartitionByRange(*key).sortWithinPartitions(*key).write.parquet(f"{path}/base/{number}/rows")
    spark.createDataFrame(seen, "source string, upto long").coalesce(1).write.parquet(f"{path}/base/{number}/covered")


def probed(parts: Sequence[DataFrame], probes: DataFrame, key: str) -> DataFrame:
    """The records of the probed keys alone.  The keys' range, and the keys themselves if
    they are few, filter the scans, where sorted files let whole row groups be skipped; a
    semi join does the rest before any record is folded."""
    keys = probes.select(key).where(F.col(key).isNotNull()).distinct()
    ends = keys.agg(F.min(key).alias("least"), F.max(key).alias("most"), F.count(F.lit(1)).alias("n")).first()
    here = F.col(key).between(ends["least"], ends["most"])
    if 0 < ends["n"] <= LISTED:
        here = here & F.col(key).isin([r[0] for r in keys.collect()])
    return _union([p.where(here) for p in parts]).join(keys, key, "left_semi")


def lookup(spark: SparkSession, path: str, probes: DataFrame, key: str = "file_name") -> DataFrame:
    """every probe row with ``found``, ``status`` ('missing' when absent) and ``row_count``
    of the newest record of its key."""
    newest = _latest(probed(read_parts(spark, path), probes, key), [key]).select(key, "status", "row_count")
    j = probes.join(newest, key, "left")
    return j.select(*probes.columns, F.col("status").isNotNull().alias("found"),
                    F.coalesce("status", F.lit("missing")).alias("status"), "row_count")
