"""Generated employee rows: closed forms at every size (FIXTURES §5)."""

from pyspark.sql import functions as F

from tessera.operators import profile as P
from tessera.operators.cells import to_cells
from tessera.sources import generator as G

# rows -> (age min, max, avg, salary min, max, avg)
GOLDENS = {
    10: (25, 34, 29.5, 50000, 59000, 54500),
    50: (25, 64, 41.5, 50000, 99000, 74500),
    100: (25, 64, 42.5, 50000, 149000, 99500),
    500: (25, 64, 44.1, 50000, 149000, 99500),
    1000: (25, 64, 44.5, 50000, 149000, 99500),
    5000: (25, 64, 44.5, 50000, 149000, 99500),
    10000: (25, 64, 44.5, 50000, 149000, 99500),
    20000: (25, 64, 44.5, 50000, 149000, 99500),
}


def test_generated_employee_profiles(spark):
    ids = None
    for f, n in enumerate(GOLDENS):
        part = spark.range(n).select(F.lit(f).cast("bigint").alias("file_id"), F.col("id").alias("i"))
        ids = part if ids is None else ids.unionByName(part)
    emps = G.employees(ids)
    cells = to_cells(emps.withColumnRenamed("i", "row_no"), ("file_id", "row_no"), G.HEADER)
    prof = {(r["file_id"], r["column"]): r for r in P.column_profile(cells, ["file_id"]).collect()}
    for f, (n, g) in enumerate(GOLDENS.items()):
        age, sal = prof[(f, "age")], prof[(f, "salary")]
        assert (age["type"], sal["type"]) == ("int", "int")
        assert (age["stat_min"], age["stat_max"], round(age["stat_avg"], 1)) == g[:3], n
        assert (sal["stat_min"], sal["stat_max"], round(sal["stat_avg"], 1)) == g[3:], n
        assert prof[(f, "join_date")]["type"] == "date"
        assert {prof[(f, c)]["type"] for c in ("name", "department", "city", "employee_id")} == {"string"}
        assert age["stat_count"] == n and age["n_missing"] == 0
    first = emps.where("file_id = 0 AND i = 7").first()
    assert (first["employee_id"], first["join_date"], first["department"], first["city"]) == \
        ("EMP00000007", "2022-08-08", "Marketing", "London")
