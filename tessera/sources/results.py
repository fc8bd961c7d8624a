"""Run-result documents.

A result document is one JSON object per run set (``environment``,
``timestamp``, ``experiments{...}``); it is read with an explicit schema
(no inference pass) and flattened with struct access and ``posexplode`` into
the long tables the run/compare operators take.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.ranking import latest_per_key

D = T.DoubleType()
STATS = T.StructType([T.StructField("count", T.LongType())] +
                     [T.StructField(n, D) for n in ("min", "max", "mean", "median", "p90", "p95", "stdev")])

# Fixed value: the stage names of the end-to-end timing experiment.
B_STAGES = ["T_upload", "T_event_latency", "T_processing", "T_total_pipeline"]

RESULTS_SCHEMA = T.StructType([
    T.StructField("environment", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("total_experiment_time", D),
    T.StructField("experiments", T.StructType([
        T.StructField("A_deployment_speed", T.StructType([
            T.StructField("description", T.StringType()), T.StructField("num_runs", T.LongType()),
            T.StructField("operation", T.StringType()), T.StructField("times", STATS)])),
        T.StructField("B_e2e_timing", T.StructType(
            [T.StructField("description", T.StringType()), T.StructField("num_runs", T.LongType()),
             T.StructField("rows_per_file", T.LongType()), T.StructField("failures", T.LongType())]
            + [T.StructField(s, STATS) for s in B_STAGES])),
        T.StructField("D_failure_injection", T.StructType([
            T.StructField("description", T.StringType()),
            T.StructField("test_cases", T.ArrayType(T.StructType([
                T.StructField("test", T.StringType()), T.StructField("upload_success", T.BooleanType()),
                T.StructField("expected_status", T.StringType()), T.StructField("actual_status", T.StringType()),
                T.StructField("processing_time", D), T.StructField("match", T.BooleanType()),
                T.StructField("error_message", T.StringType()), T.StructField("upload_error", T.StringType())]))),
            T.StructField("total_tests", T.LongType()), T.StructField("matches", T.LongType())])),
        T.StructField("F_file_size_scaling", T.StructType([
            T.StructField("description", T.StringType()),
            T.StructField("results", T.ArrayType(T.StructType([
                T.StructField("rows", T.LongType()), T.StructField("file_size_kb", D),
                T.StructField("success", T.BooleanType()), T.StructField("upload_time", D),
                T.StructField("processing_time", D), T.StructField("total_time", D),
                T.StructField("throughput_rows_per_sec", D), T.StructField("error", T.StringType())])))])),
        T.StructField("G_parallel_scaling", T.StructType([
            T.StructField("description", T.StringType()),
            T.StructField("results", T.ArrayType(T.StructType([
                T.StructField("parallel_level", T.LongType()), T.StructField("successful_uploads", T.LongType()),
                T.StructField("successful_processing", T.LongType()), T.StructField("upload_time", D),
                T.StructField("processing_time", D), T.StructField("upload_throughput", D),
                T.StructField("processing_throughput", D)])))])),
        T.StructField("H_iam_fidelity", T.StructType([
            T.StructField("description", T.StringType()),
            T.StructField("tests", T.ArrayType(T.StructType([
                T.StructField("test", T.StringType()), T.StructField("expected", T.StringType()),
                T.StructField("actual", T.StringType()), T.StructField("matches", T.BooleanType()),
                T.StructField("error", T.StringType())]))),
            T.StructField("total_tests", T.LongType()), T.StructField("matches", T.LongType()),
            T.StructField("note", T.StringType())])),
    ])),
])


def read_results(spark: SparkSession, paths: str | Sequence[str], multiline: bool = True) -> DataFrame:
    """S3: result documents with the file path.  ``multiline`` for
    pretty-printed files (one document each); JSON lines otherwise."""
    df = spark.read.schema(RESULTS_SCHEMA).option("multiLine", multiline).json(paths)
    return df.select("*", F.col("_metadata.file_path").alias("source_path"),
                     F.col("_metadata.file_modification_time").alias("source_mtime"))


def latest_per_environment(results: DataFrame) -> DataFrame:
    """Newest document per environment (``ls -t | head -1``)."""
    return latest_per_key(results, ["environment"], ["source_mtime", "source_path"])


def with_arm(results: DataFrame, arms: dict[str, str] | None = None) -> DataFrame:
    """Generalise the environment name to an arm label (default: unchanged)."""
    if not arms:
        return results.withColumn("arm", F.col("environment"))
    m = F.create_map(*[x for k, v in arms.items() for x in (F.lit(k), F.lit(v))])
    return results.withColumn("arm", F.coalesce(m[F.col("environment")], F.col("environment")))


def stage_stats(results: DataFrame) -> DataFrame:
    """The end-to-end stage statistics as (arm, stage, count, min, ..., stdev)."""
    b = F.col("experiments.B_e2e_timing")
    stages = F.array(*[F.struct(F.lit(s).alias("stage"), b[s].alias("s")) for s in B_STAGES])
    ex = results.select("arm", F.explode(stages).alias("x"))
    return ex.select("arm", F.col("x.stage").alias("stage"),
                     *[F.col(f"x.s.{f.name}").alias(f.name) for f in STATS.fields])


def size_results(results: DataFrame) -> DataFrame:
    """File-size results as per-level rows (level = rows), list position kept."""
    ex = results.select("arm", F.posexplode("experiments.F_file_size_scaling.results").alias("pos", "r"))
    return ex.select("arm", "pos", F.col("r.rows").alias("level"), F.col("r.rows").alias("rows"),
                     F.col("r.file_size_kb").alias("file_size_kb"),
                     F.coalesce("r.success", F.lit(False)).alias("success"),
                     F.col("r.processing_time").alias("proc_seconds"),
                     F.coalesce("r.throughput_rows_per_sec", F.lit(0.0)).alias("rows_per_sec"))


def parallel_results(results: DataFrame) -> DataFrame:
    """Parallel-scaling results as per-level rows."""
    ex = results.select("arm", F.posexplode("experiments.G_parallel_scaling.results").alias("pos", "r"))
    return ex.select("arm", "pos", F.col("r.parallel_level").alias("level"),
                     F.col("r.processing_throughput").alias("files_per_sec"),
                     F.col("r.upload_throughput").alias("upload_files_per_sec"),
                     F.lit(None).cast("double").alias("rows_per_sec"),
                     (F.try_divide("r.successful_processing", "r.parallel_level") * 100).alias("success_rate"),
                     F.col("r.processing_time").alias("proc_seconds"))


def failure_cases(results: DataFrame, experiment: str = "D_failure_injection",
                  field: str = "test_cases", actual: str = "actual_status") -> DataFrame:
    """Named cases as (arm, test, pos, status, outcome, expected_status)."""
    ex = results.select("arm", F.posexplode(f"experiments.{experiment}.{field}").alias("pos", "c"))
    exp = "expected_status" if experiment == "D_failure_injection" else "expected"
    return ex.select("arm", F.coalesce("c.test", F.lit("Unknown")).alias("test"), "pos",
                     F.coalesce(f"c.{actual}", F.lit("unknown")).alias("status"),
                     F.coalesce(f"c.{actual}", F.lit("unknown")).alias("outcome"),
                     F.col(f"c.{exp}").alias("expected_status"))


def scalar_metrics(df: DataFrame, keys: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """Scalar columns as (keys, metric, value) rows; nested values skipped."""
    numeric = [c for c in value_cols
               if isinstance(df.schema[c].dataType, (T.NumericType,))]
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in numeric]) \
        .unpivot(list(keys), numeric, "metric", "value")
