"""Arrival -> completion within a deadline, as a stream-stream left outer join.

Both sides carry event-time watermarks; the join condition bounds the
completion time to [arrive_ts, arrive_ts + deadline], which lets Spark drop
join state once the watermark passes and emit each unmatched arrival (a
timeout) exactly once, after the watermark passes arrive_ts + deadline.

The watermark delay is the lateness of the feed, not the span of its data: a feed is
one log of arrivals and completions, read in time order.  Past events are replayed as
such a log (``write_replay_log``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def deadline_join(arrivals: DataFrame, completions: DataFrame, deadline: str = "30 days",
                  arrival_delay: str | None = "1 day", completion_delay: str | None = "1 day",
                  key: str = "object_id") -> DataFrame:
    """Streaming (or batch) left outer join of arrivals with completions.

    A delay of None: the side has its watermark already.
    Output: key, arrive_ts, done_ts and the completion's status (both NULL
    when no completion came in time: a timeout).
    """
    a = arrivals.select(F.col(key).alias("a_key"), "arrive_ts")
    c = completions.select(F.col(key).alias("c_key"), "done_ts", F.col("status").alias("c_status"))
    a = a.withWatermark("arrive_ts", arrival_delay) if arrival_delay else a
    c = c.withWatermark("done_ts", completion_delay) if completion_delay else c
    cond = F.expr(f"a_key = c_key AND done_ts >= arrive_ts AND done_ts <= arrive_ts + INTERVAL {deadline}")
    j = a.join(c, cond, "leftOuter")
    return j.select(F.col("a_key").alias(key), "arrive_ts", "done_ts", F.col("c_status").alias("status"))


def summarize(matches: DataFrame, key: str = "object_id") -> DataFrame:
    """Per arrival: number of completions in time, first one, done/timeout."""
    return matches.groupBy(key).agg(
        F.count("done_ts").alias("n_matches"),
        F.min("done_ts").alias("first_done"),
    ).select(key, F.when(F.col("n_matches") > 0, F.lit("done")).otherwise(F.lit("timeout")).alias("status"),
             "n_matches", "first_done")


LOG_SCHEMA = "object_id bigint, ts timestamp, kind string, status string"


def write_replay_log(arrivals: DataFrame, completions: DataFrame, path: str, steps: int = 4) -> None:
    """``arrivals(object_id, arrive_ts)`` and ``completions(object_id, done_ts, status)`` as a
    log in time order: ``steps`` appends of one equal span of time each, so that a reader
    of one file at a time sees no event before an earlier span's."""
    spark = arrivals.sparkSession
    log = arrivals.select("object_id", F.col("arrive_ts").cast("timestamp").alias("ts"), F.lit("arrival").alias("kind"),
                          F.lit(None).cast("string").alias("status"))
    log = log.unionByName(completions.select("object_id", F.col("done_ts").cast("timestamp").alias("ts"),
                                             F.lit("completion").alias("kind"), "status"))
    ends = log.agg(F.unix_timestamp(F.min("ts")).alias("a"), F.unix_timestamp(F.max("ts")).alias("b")).first()
    span = max(1, (ends["b"] - ends["a"]) // steps + 1) if ends["a"] is not None else 1
    step = F.floor((F.unix_timestamp("ts") - F.lit(ends["a"] or 0)) / span)
    log.withColumn("step", step.cast("int")).write.partitionBy("step").parquet(path + "_steps")
    parts = spark.read.schema(LOG_SCHEMA + ", step int").parquet(path + "_steps")
    for k in range(steps):
        parts.where(F.col("step") == k).drop("step").coalesce(1).write.mode("append").parquet(path)


def replay_deadlines(spark: SparkSession, path: str, out: str, checkpoint: str, deadline: str = "30 days",
                     delay: str = "1 day"):
    """Start the deadline join over a log, one file a batch; results go to ``out``."""
    log = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path).withWatermark("ts", delay)
    arrivals = log.where("kind = 'arrival'").select("object_id", F.col("ts").alias("arrive_ts"))
    completions = log.where("kind = 'completion'").select("object_id", F.col("ts").alias("done_ts"), "status")
    matches = deadline_join(arrivals, completions, deadline, None, None)
    return (matches.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
