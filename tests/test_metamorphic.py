"""Metamorphic checks: the profile of a union of files is the union of their
profiles; repartitioning the input never changes a profile; a re-delivered
notification batch leaves the latest metadata view unchanged."""

from pyspark.sql import functions as F

from helpers import SF001, write_files
from tessera.operators import profile as P
from tessera.plans.registry import dirty_cells
from tessera.session import qualify, shared_dir


def rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def test_union_of_files(spark):
    cells = dirty_cells(spark, SF001)
    whole = P.column_profile(cells).where("file_name = 'click.csv'")
    alone = P.column_profile(cells.where("file_name = 'click.csv'"))
    assert rows(whole.drop("stat_avg")) == rows(alone.drop("stat_avg"))


def test_repartition_invariance(spark):
    cells = dirty_cells(spark, SF001)
    a = P.column_profile(cells)
    b = P.column_profile(cells.repartition(7, "ordinal"))
    cols = [c for c in a.columns if c != "stat_avg"]
    assert rows(a.select(cols)) == rows(b.select(cols))


def test_stream_redelivery_is_idempotent(spark, tmpdir_path):
    from tessera.plans.registry import write_notifications
    from tessera.streaming import profile_stream as PS
    root = tmpdir_path + "/data"
    write_files(root, {"uploads/a.csv": "x,y\n1,2\n3,4\n", "uploads/b.csv": "x\n", "uploads/c.csv": "p,q\n1\n"})
    base = shared_dir(spark, "test", "redelivery")
    write_notifications(spark, root, base + "/n1", n_files=1)
    write_notifications(spark, root, base + "/n2", n_files=1)
    for n in ("n1", "n2"):  # the second run replays the same notifications
        q = PS.start_profile_stream(spark, base + "/" + n, qualify(spark, root).rstrip("/") + "/",
                                    base + "/log", base + "/ckpt_" + n, prefix="uploads/", suffix=".csv",
                                    summary_dir=base + "/summaries")
        q.awaitTermination()
    cur = {r["file_name"]: (r["status"], r["row_count"]) for r in PS.current_status(spark, base + "/log").collect()}
    assert cur == {"a.csv": ("success", 2), "b.csv": ("error", 0), "c.csv": ("error", 0)}
    log = spark.read.parquet(base + "/log")
    assert log.count() == 6
    totals = {r["status"]: r["n_files"] for r in PS.status_totals(spark, base + "/log").collect()}
    assert totals == {"success": 1, "error": 2}
    assert log.select(F.countDistinct("batch_id")).first()[0] >= 1
    docs = spark.read.json(base + "/summaries")  # K1: only the successful file, once per delivery
    assert {(r["file_name"], r["summary_key"], r["row_count"]) for r in docs.collect()} == \
        {("a.csv", "processed/a_summary.json", 2)}
    assert docs.count() == 2
    rec = {r["file_name"]: r for r in PS.current_status(spark, base + "/log").collect()}
    assert rec["a.csv"]["schema"] == {"x": "int", "y": "int"}      # K2: the record carries the summary
    assert rec["a.csv"]["statistics"]["y"]["max"] == 4.0
    assert rec["c.csv"]["schema"] is None and rec["c.csv"]["error_message"]


def test_typed_table_profile(spark):
    """Schema-aware profile: typed columns from the schema, NULL = missing,
    NaN out of min/max/avg, text columns inferred as text."""
    import datetime
    import decimal

    from tessera.operators.profile import profile_table
    rows = [(1, 1.5, decimal.Decimal("2.50"), decimal.Decimal("7"), datetime.date(2022, 1, 5), "2022-01-05", True),
            (None, float("nan"), decimal.Decimal("1.25"), decimal.Decimal("9"), None, "2022-02-01", False),
            (5, None, None, decimal.Decimal("8"), datetime.date(2021, 3, 1), "  ", None),
            (3, -2.0, decimal.Decimal("4.00"), None, datetime.date(2020, 7, 9), "2020-07-09", True)]
    schema = "i int, d double, p decimal(10,2), k decimal(10,0), dt date, s string, b boolean"
    prof = {r["column"]: r for r in profile_table(spark.createDataFrame(rows, schema), "t").collect()}
    assert {c: r["type"] for c, r in prof.items()} == {
        "i": "int", "d": "float", "p": "float", "k": "int", "dt": "date", "s": "date", "b": "string"}
    assert (prof["i"]["stat_min"], prof["i"]["stat_max"], prof["i"]["stat_avg"], prof["i"]["n_missing"]) == \
        (1.0, 5.0, 3.0, 1)
    assert (prof["d"]["stat_min"], prof["d"]["stat_max"], prof["d"]["stat_count"], prof["d"]["nan_count"]) == \
        (-2.0, 1.5, 3, 1)  # the count includes NaN, as in the text path
    assert prof["d"]["stat_avg"] == -0.25
    assert (prof["p"]["stat_min"], prof["p"]["stat_max"]) == (1.25, 4.0)
    assert prof["s"]["n_missing"] == 1 and prof["b"]["n_missing"] == 1
    assert [prof[c]["ordinal"] for c in "i d p k dt s b".split()] == list(range(1, 8))
