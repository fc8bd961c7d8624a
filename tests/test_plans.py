"""Physical-plan properties the scale design relies on (checked on the plan
Spark builds before adaptive re-planning)."""

from helpers import SF01

from pyspark.sql import functions as F

from tessera.operators import profile as P
from tessera.operators import ranking as K
from tessera.plans.registry import QUERIES, dirty_cells
from tessera.sources import bindings as B


def plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def executed_plan(df) -> str:
    """Physical plan with exchanges (before adaptive re-planning at run time)."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_profile_is_expand_plus_hash_aggregate_without_python(spark):
    cells = dirty_cells(spark, SF01)
    flags = P.date_flags(P.cell_flags(cells))
    aggs = [F.min(F.when(~F.col(name), F.col("row_no"))) for name in P.DATE_FLAG_NAMES]
    p = plan(flags.groupBy("file_name", "ordinal", "column").agg(F.min("int_value"), F.sum("float_value"), *aggs))
    assert "Expand" in p
    assert "HashAggregate" in p
    assert "SortAggregate" not in p            # no string/object buffers on the cell aggregation
    assert "Window" not in p                   # the date rule needs no order
    assert "EvalPython" not in p and "PythonUDF" not in p


def test_cells_are_read_once(spark, monkeypatch):
    """Columns of one kind of value are decided by the first aggregation."""
    def never(*_):
        raise AssertionError("second pass")
    monkeypatch.setattr(P, "_probe", never)
    monkeypatch.setattr(P, "exact_integers", never)
    cells = dirty_cells(spark, SF01).where("column <> 'c_latebad'")
    assert P.column_profile(cells).count() == 35


def test_latest_and_first_are_hash_aggregates(spark):
    for name in ("meta_latest", "dedupe_first", "src_latest_per_env"):
        p = plan(QUERIES[name][0](spark, SF01))
        assert "Window" not in p, name
        assert "Aggregate" in p, name


def test_statistics_read_the_runs_once(spark):
    """Counts of distinct values are kept; no statistic goes back to the runs, no group to one task."""
    for name in ("run_stats", "cmp_metrics", "run_percentiles"):
        p = plan(QUERIES[name][0](spark, SF01))
        assert "events.parquet" not in p and "ranking/counts" in p, name
    df = spark.createDataFrame([("a", float(i)) for i in range(100)], "g string, v double")
    assert "SinglePartition" not in plan(K.percentiles(df, ["g"], "v"))


def test_reconcile_joins_on_the_key_without_reshuffling_the_aggregate(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = executed_plan(QUERIES["reconcile_deadline"][0](spark, SF01))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p
    # one exchange for the partial aggregate of line items, one for orders
    assert p.count("Exchange hashpartitioning") == 2


def _one_row_group(spark, folder, rows):
    import pyarrow as pa
    import pyarrow.parquet as pq
    path = f"{folder}/one.parquet"
    pq.write_table(pa.table({"k": list(range(rows)), "t": [f"text {i * 7919 % rows:09d}" for i in range(rows)]}), path,
                   row_group_size=rows, compression="none", use_dictionary=False)
    return spark.read.parquet(path)


def test_one_row_group_of_many_splits_is_spread(spark, tmpdir_path):
    from tessera.operators.cells import to_cells
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        df = _one_row_group(spark, tmpdir_path, 300_000)
        assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        cells = to_cells(df, ("k",), ["t"])
        sizes = [r["count"] for r in cells.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 300_000 and max(sizes) < 150_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_columns_of_one_row_group_are_read_apart_and_no_row_moves(spark, tmpdir_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from tessera.operators.cells import ordered_rows, to_cells
    names, rows = [f"c{i}" for i in range(6)], 150_000
    pq.write_table(pa.table({c: [f"{c} {j * 7919 % rows:09d}" for j in range(rows)] for c in names}), f"{tmpdir_path}/one.parquet",
                   row_group_size=rows, compression="none", use_dictionary=False)
    df = ordered_rows(spark.read.parquet(f"{tmpdir_path}/one.parquet")).withColumn("file_name", F.lit("t"))
    cells = to_cells(df, ("file_name", "row_no"), names)
    assert "Exchange" not in cells._jdf.queryExecution().executedPlan().toString()
    sizes = [r["count"] for r in cells.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 6 * rows and max(sizes) * spark.sparkContext.defaultParallelism <= 2 * 6 * rows
    got = {(r["column"], r["ordinal"]): (r["n"], r["rows"], r["last"]) for r in cells.groupBy("column", "ordinal").agg(
        F.count("*").alias("n"), F.countDistinct("row_no").alias("rows"), F.max_by("value", "row_no").alias("last")).collect()}
    assert got == {(c, i + 1): (rows, rows, f"{c} {(rows - 1) * 7919 % rows:09d}") for i, c in enumerate(names)}


def test_even_files_are_not_shuffled_for_cells(spark, tmpdir_path):
    from tessera.operators.cells import ordered_rows, to_cells
    spark.range(0, 40_000, 1, 8).selectExpr("id", "cast(id as string) AS t").write.parquet(tmpdir_path + "/t")
    df = spark.read.parquet(tmpdir_path + "/t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")       # as for a table of unknown size
    try:
        rows = ordered_rows(df)
        cells = to_cells(rows.select(F.lit("t").alias("file_name"), "row_no", "t"))
        plan = cells._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "hashpartitioning(row_no" not in plan and "hashpartitioning(file_name" not in plan
        assert cells.select("row_no").distinct().count() == 40_000
        in_order = [int(r["t"]) for r in rows.orderBy("row_no").collect()]
        assert sorted(in_order) == list(range(40_000))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dates_out_of_range_reach_no_parser():
    import re

    from tessera.functions.predicates import DATE_FORMATS
    shapes = {name: re.compile(shape) for name, _, shape in DATE_FORMATS}
    assert not shapes["%m/%d/%Y"].match("13/01/2022") and not shapes["%d/%m/%Y"].match("01/13/2022")
    assert shapes["%m/%d/%Y"].match("12/31/2022") and shapes["%d/%m/%Y"].match(" 5/1/2022")
