"""py_round (Spark) and py_round_sql (DuckDB) against Python's round()."""

import math
import random

import duckdb
from pyspark.sql import functions as F

from tessera.functions.rounding import py_round, py_round_sql


def values(n: int = 3000):
    rnd = random.Random(7)
    out = [0.125, 2.675, 0.625, 91.35, 60.5, 1.005, -2.5, -0.125, 1e-9, 123456.785, 0.0, -0.0,
           float("inf"), float("-inf"), 1e300, 4503599627370497.0]
    for _ in range(n):
        kind = rnd.random()
        if kind < 0.3:  # exact binary ties
            out.append(rnd.randint(-10**6, 10**6) / 2 ** rnd.randint(1, 6))
        elif kind < 0.6:  # decimal "ties" that are not exact in binary
            out.append(round(rnd.uniform(-1e4, 1e4), 3) + rnd.choice([0.0005, -0.0005, 0.005]))
        else:
            out.append(rnd.uniform(-1e6, 1e6) * 10 ** rnd.randint(-6, 3))
    return out


def same(a, b):
    if a is None or b is None:
        return a is b
    if math.isnan(a) or math.isnan(b):
        return math.isnan(a) and math.isnan(b)
    return a == b


def test_spark_and_duckdb_round_like_python(spark):
    vals = values()
    digits = [0, 1, 2, 3, 6]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, x double")
    got = df.select("i", *[py_round("x", n).alias(f"r{n}") for n in digits]).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i BIGINT, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(vals)))
    duck = con.execute("SELECT i, " + ", ".join(f"{py_round_sql('x', n)} AS r{n}" for n in digits)
                       + " FROM t ORDER BY i").fetchall()
    bad = []
    for row, drow in zip(sorted(got, key=lambda r: r["i"]), duck):
        x = vals[row["i"]]
        for j, n in enumerate(digits):
            want = round(x, n) if math.isfinite(x) else x
            if not (same(row[f"r{n}"], want) and same(drow[1 + j], want)):
                bad.append((x, n, want, row[f"r{n}"], drow[1 + j]))
    assert not bad, bad[:10]
