"""Profile files as their arrival notifications stream in.

Notifications (object-created events, one JSON document per line) are read
with ``readStream``; every micro-batch routes them (prefix / suffix / event
type), turns the routed objects into a manifest and runs the batch profile
on exactly those files inside ``foreachBatch``.  Results go to the
metadata log, one folder per batch of this stream: a redelivered batch replaces
its folder, so that the log holds every record once.
A bad file yields an ``error`` record; it never fails the micro-batch.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.derived import last_segment
from tessera.operators import metadata as meta_ops
from tessera.operators import metalog
from tessera.operators import profile as prof_ops
from tessera.sinks.writers import write_summaries
from tessera.sources import csv_files as csv_ops
from tessera.sources import events as ev_ops


def records_from_status(files: DataFrame, manifest: DataFrame, docs: DataFrame | None = None) -> DataFrame:
    """Metadata records (K2 shape) from per-file status rows; with ``docs``
    (summary documents keyed by file_path) they also carry the file's schema,
    statistics and quality issues (NULL for error records, which carry
    ``error_message`` instead)."""
    up = manifest.select("file_path", "upload_timestamp")
    recs = files.join(up, "file_path", "left")
    extra = []
    if docs is not None:
        recs = recs.join(docs.select("file_path", "schema", "statistics", "quality_issues"), "file_path", "left")
        extra = ["schema", "statistics", "quality_issues"]
    return recs.select(
        "file_path", "file_name", "upload_timestamp",
        F.localtimestamp().alias("processed_ts"),
        F.lit(0).cast("bigint").alias("seq"),
        "status", "error_message", "row_count", *extra)


def summaries_from_profile(columns: DataFrame, files: DataFrame, manifest: DataFrame) -> DataFrame:
    """K1 documents for the successfully processed files of a batch."""
    ok = csv_ops.successful_columns(columns, files)
    per_file = prof_ops.file_profile(ok, keys=["file_path"])
    up = manifest.select("file_path", "upload_timestamp")
    return prof_ops.summary_document(
        per_file.join(up, "file_path", "left").withColumn("file_name", last_segment("file_path")),
        upload_col="upload_timestamp", keep=["file_path"])


def start_profile_stream(spark: SparkSession, notifications_dir: str, base_uri: str, log_path: str,
                         checkpoint: str, prefix: str = ev_ops.UPLOAD_PREFIX, suffix: str = ev_ops.CSV_SUFFIX,
                         max_files_per_trigger: int | None = None, available_now: bool = True,
                         summary_dir: str | None = None):
    """Start the stream; ``base_uri`` + object key = file path.  Each batch
    appends status records to ``log_path`` and, with ``summary_dir``, the
    summary documents of its successful files (K1)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(notifications_dir)
    # Batches are numbered per checkpoint: it names the source of the log's records.
    source = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def process(batch: DataFrame, batch_id: int) -> None:
        routed = ev_ops.route(ev_ops.decode_events(batch, "value"), prefix, suffix)
        # at-least-once delivery: one row per object, its latest notification
        manifest = ev_ops.manifest_from_events(routed, base_uri).groupBy("file_path").agg(
            F.max("length").alias("length"), F.max("upload_timestamp").alias("upload_timestamp"))
        if manifest.isEmpty():
            return
        columns, files = csv_ops.profile_files(spark, manifest)
        docs = summaries_from_profile(columns, files, manifest)
        if summary_dir:
            write_summaries(docs.drop("file_path").withColumn("batch_id", F.lit(batch_id).cast("bigint")),
                            summary_dir)
        metalog.append(records_from_status(files, manifest, docs), log_path, batch_id, source)

    writer = raw.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def current_status(spark: SparkSession, log_path: str) -> DataFrame:
    """Latest record per file from the stream's log (R2)."""
    return metalog.current(spark, log_path, key=("file_path",))


def status_totals(spark: SparkSession, log_path: str) -> DataFrame:
    """File counts and row totals by status over the current view."""
    return meta_ops.status_counts(current_status(spark, log_path))
