"""Metadata log, latest view, lookups and reconciliation.

The reference upserts one record per file name (last write wins).  On Spark
the log is append-only (any number of writers, at-least-once retries are
harmless) and "current state" is a view: ``max_by`` per key, a hash aggregate
with map-side partial aggregation.  Reconciliation joins arrivals with
completions on the object key: both sides are large, so these are shuffle
(sort-merge) joins on one key with AQE skew handling; nothing is broadcast
unless AQE measures it small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.ranking import latest_per_key

METADATA_SCHEMA = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("processed_ts", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])


def append_log(records: DataFrame, path: str, batch_id: int = 0, fmt: str = "json") -> None:
    """K2/R2: append records to the metadata log.

    JSON lines drop NULL fields (K3: ``error_message`` only when set); parquet
    keeps them.  ``batch_id`` makes redelivered batches distinguishable.
    """
    out = records.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    out.write.mode("append").format(fmt).save(path)


def read_log(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(METADATA_SCHEMA).format(fmt).load(path)


def latest(log: DataFrame, key: Sequence[str] = ("file_name",),
           order: Sequence[str] = ("processed_ts", "seq", "batch_id")) -> DataFrame:
    """The current record per key (upsert semantics as a view)."""
    order = [c for c in order if c in log.columns]
    return latest_per_key(log, list(key), order)


def lookup(latest_view: DataFrame, probes: DataFrame, key: str = "file_name") -> DataFrame:
    """look every probe key up in a latest view: found flag + status
    ('missing' when absent).  For a log in files see ``metalog.lookup``."""
    j = probes.join(latest_view.select(key, "status", "row_count"), key, "left")
    return j.select(*probes.columns, F.col("status").isNotNull().alias("found"),
                    F.coalesce("status", F.lit("missing")).alias("status"),
                    F.col("row_count"))


def reconcile_processed(arrivals: DataFrame, completions: DataFrame, key: str = "object_id",
                        by: Sequence[str] = ("priority",)) -> DataFrame:
    """Arrivals that have a successful completion, counted against all arrivals
    per group; one join, both counts from it."""
    by = list(by)
    ok = completions.where(F.col("status") == "success").select(F.col(key).alias("_done")).distinct()
    return arrivals.join(ok, arrivals[key] == F.col("_done"), "left").groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_uploaded"), F.count("_done").alias("n_processed"))


def reconcile_missing(arrivals: DataFrame, completions: DataFrame, key: str = "object_id") -> DataFrame:
    """Arrivals with no completion record at all (anti join)."""
    return arrivals.join(completions.select(key), key, "left_anti")


def reconcile_deadline(arrivals: DataFrame, completions: DataFrame, deadline: str = "30 days",
                       key: str = "object_id") -> DataFrame:
    """Arrival <-> completion within a deadline; no completion in
    [arrive_ts, arrive_ts + deadline] -> 'timeout'."""
    a = arrivals.select(key, "arrive_ts")
    c = completions.select(key, "done_ts", "status")
    cond = [a[key] == c[key], c["done_ts"] >= a["arrive_ts"],
            c["done_ts"] <= a["arrive_ts"] + F.expr(f"INTERVAL {deadline}")]
    j = a.join(c, cond, "left")
    return j.select(
        a[key].alias(key),
        F.coalesce(c["status"], F.lit("timeout")).alias("status"),
        F.expr("timestampdiff(SECOND, arrive_ts, done_ts)").alias("wait_seconds"))


def status_counts(log_or_latest: DataFrame) -> DataFrame:
    """File counts and row totals by status."""
    return log_or_latest.groupBy("status").agg(F.count(F.lit(1)).alias("n_files"),
                                               F.sum("row_count").alias("n_rows"))
