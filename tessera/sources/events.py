"""Arrival events (S6, F5-F7, P1): object-created notifications -> manifest rows.

Every record of a notification is processed (the reference reads only the
first), keys are URL-decoded (notification keys are form-encoded), and the
prefix / suffix / event-type filters become an ``action`` column instead of
dropped rows, so skipped objects stay visible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.derived import last_segment

EVENT_SCHEMA = T.StructType([T.StructField("Records", T.ArrayType(T.StructType([
    T.StructField("eventName", T.StringType()),
    T.StructField("eventTime", T.StringType()),
    T.StructField("s3", T.StructType([
        T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("object", T.StructType([T.StructField("key", T.StringType()),
                                              T.StructField("size", T.LongType())])),
    ])),
])))])

# The trigger filter of the profiled pipeline.
UPLOAD_PREFIX = "uploads/"
CSV_SUFFIX = ".csv"
CREATED_EVENT = "ObjectCreated:"


def decode_events(raw: DataFrame, body_col: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse notification JSON and emit one row per record."""
    parsed = raw.select(*keep, F.from_json(F.col(body_col), EVENT_SCHEMA).alias("e"))
    ex = parsed.select(*keep, F.posexplode("e.Records").alias("record_no", "r"))
    raw_key = F.col("r.s3.object.key")
    key = F.coalesce(F.try_url_decode(raw_key), raw_key)  # a malformed escape keeps the raw key
    return ex.select(
        *keep, "record_no",
        F.col("r.eventName").alias("event_name"),
        F.col("r.eventTime").alias("event_time"),
        F.col("r.s3.bucket.name").alias("bucket"),
        key.alias("key"),
        F.col("r.s3.object.size").alias("size"),
    )


def route(decoded: DataFrame, prefix: str = UPLOAD_PREFIX, suffix: str = CSV_SUFFIX) -> DataFrame:
    """F5-F7 + P1: file name and the action taken for each object."""
    key = F.col("key")
    action = (F.when(~F.col("event_name").startswith(CREATED_EVENT), F.lit("ignored"))
              .when(~key.endswith(suffix), F.lit("ignored"))
              .when(~key.startswith(prefix), F.lit("skipped"))
              .otherwise(F.lit("process")))
    return decoded.select("*", last_segment(key).alias("file_name"), action.alias("action"))


def manifest_from_events(routed: DataFrame, base_uri: str | None = None, scheme: str = "s3a") -> DataFrame:
    """Objects to process as a manifest (file_path, length, upload_timestamp).

    The path is ``base_uri + key`` when a base is given, else
    ``<scheme>://<bucket>/<key>``."""
    ok = routed.where(F.col("action") == "process")
    prefix = (F.lit(base_uri) if base_uri is not None
              else F.concat(F.lit(f"{scheme}://"), F.col("bucket"), F.lit("/")))
    return ok.select(F.concat(prefix, F.col("key")).alias("file_path"),
                     F.coalesce(F.col("size"), F.lit(0)).alias("length"),
                     F.col("event_time").alias("upload_timestamp"))
