"""The metadata log in files, the replayed deadline join, decimal leaves and whole-object
writes against plain Python."""

import datetime as dt
import json
import os
import random

from pyspark.sql import functions as F

from tessera.operators import metalog
from tessera.sinks import writers as W
from tessera.streaming import deadline as D

SCHEMA = "file_name string, processed_ts timestamp, seq long, status string, row_count long"


def record(rng, k):
    return (f"f{rng.randrange(40)}.csv", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=k), k, rng.choice(["success", "error"]), k * 10)


def newest(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        out[r[0]] = r
    return out


def test_batches_folds_and_redelivery(spark, tmpdir_path):
    rng = random.Random(1)
    path = tmpdir_path + "/log"
    batches = {b: [record(rng, 100 * b + k) for k in range(60)] for b in range(5)}
    seen = []
    for b, rows in batches.items():
        df = spark.createDataFrame(rows, SCHEMA)
        metalog.append(df, path, b, "one")
        metalog.append(df, path, b, "one")          # delivered again
        seen += rows
        if b in (1, 3):
            metalog.compact(spark, path)
        got = {r.file_name: (r.file_name, r.processed_ts, r.seq, r.status, r.row_count) for r in metalog.current(spark, path).collect()}
        assert got == newest(seen)
    assert spark.read.parquet(path + "/log").count() == 300
    # A batch that was folded in is not opened again; a source of its own is.
    fresh = metalog.read_parts(spark, path)[-1]
    assert {r.batch_id for r in fresh.select("batch_id").distinct().collect()} == {4}
    other = spark.createDataFrame([("f1.csv", dt.datetime(2030, 1, 1), 0, "late", 1)], SCHEMA).withColumn("extra", F.lit("x"))
    metalog.append(other, path, 0, "two")
    cur = {r.file_name: r for r in metalog.current(spark, path).collect()}
    assert cur["f1.csv"].status == "late" and cur["f1.csv"].extra == "x" and len(cur) == len(newest(seen))


def test_interrupted_fold_is_passed_over(spark, tmpdir_path):
    path = tmpdir_path + "/log"
    metalog.append(spark.createDataFrame([record(random.Random(2), 1)], SCHEMA), path, 0)
    metalog.compact(spark, path)
    os.makedirs(path + "/base/7/rows")              # no success mark
    assert metalog.current(spark, path).count() == 1
    metalog.compact(spark, path)
    assert os.path.exists(path + "/base/8/covered/_SUCCESS") and metalog.current(spark, path).count() == 1


def test_lookup_reads_the_probed_keys_alone(spark, tmpdir_path):
    rng = random.Random(3)
    path = tmpdir_path + "/log"
    rows = [record(rng, k) for k in range(400)]
    metalog.append(spark.createDataFrame(rows, SCHEMA), path, 0)
    metalog.compact(spark, path)
    probes = spark.createDataFrame([("f3.csv",), ("f3.csv",), ("none.csv",), (None,)], "file_name string")
    got = sorted(map(str, [tuple(r) for r in metalog.lookup(spark, path, probes).collect()]))
    want = newest(rows)["f3.csv"]
    assert got == sorted(map(str, [("f3.csv", True, want[3], want[4])] * 2 + [("none.csv", False, "missing", None), (None, False, "missing", None)]))
    plan = metalog.probed(metalog.read_parts(spark, path), probes, "file_name")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(file_name), GreaterThanOrEqual(file_name,f3.csv)" in plan or "In(file_name, [f3.csv,none.csv])" in plan
    assert metalog.lookup(spark, path, probes.limit(0)).count() == 0


def test_state_of_the_deadline_join_is_dropped(spark, tmpdir_path):
    """A year of arrivals replayed in spans: timeouts come out, state stays within a span."""
    rng = random.Random(4)
    day = dt.datetime(2023, 1, 1)
    arrivals = [(i, day + dt.timedelta(hours=rng.randrange(24 * 365))) for i in range(600)]
    done = [(i, at + dt.timedelta(days=rng.choice([1, 5, 9, 10, 11, 40])), "success") for i, at in arrivals if rng.random() < 0.7]
    done.append((-5, day + dt.timedelta(days=365 + 60), "success"))     # the feed goes on
    a = spark.createDataFrame(arrivals, "object_id long, arrive_ts timestamp")
    c = spark.createDataFrame(done, "object_id long, done_ts timestamp, status string")
    D.write_replay_log(a, c, tmpdir_path + "/log", steps=8)
    q = D.replay_deadlines(spark, tmpdir_path + "/log", tmpdir_path + "/out", tmpdir_path + "/ckpt", "10 days")
    q.awaitTermination()
    out = {r.object_id: (r.status, r.n_matches) for r in D.summarize(spark.read.parquet(tmpdir_path + "/out")).collect()}
    at = dict(arrivals)
    hits = {i for i, ts, _ in done if i in at and at[i] <= ts <= at[i] + dt.timedelta(days=10)}
    assert out == {i: ("done", 1) if i in hits else ("timeout", 0) for i in at}
    state = [p["stateOperators"][0]["numRowsTotal"] for p in (json.loads(x.json) if hasattr(x, "json") else x for x in q.recentProgress) if p["stateOperators"]]
    assert max(state) < (len(arrivals) + len(done)) / 2 and state[-1] <= 5


def test_decimal_leaves_at_any_depth(spark):
    row = spark.sql("""SELECT 0.1D AS x, float(0.1) AS f, 3 AS n, 'a' AS s, array(0.25D, NULL) AS a,
      map('k', named_struct('min', 1.5D, 'tags', array('t'), 'in', map('z', 2e-7D)), 'none', NULL) AS m,
      CAST(NULL AS STRUCT<v: DOUBLE>) AS nil, double('NaN') AS nan, 1e300D AS big""")
    out = W.to_decimal_leaves(row)
    assert "double" not in out.schema.simpleString() and "float" not in out.schema.simpleString()
    r = out.first()
    assert str(r.x).rstrip("0") == "0.1" and str(r.f).rstrip("0") == "0.1" and (r.n, r.s) == (3, "a")
    assert str(r.a[0]).rstrip("0") == "0.25" and r.a[1] is None
    assert str(r.m["k"]["min"]).rstrip("0") == "1.5" and r.m["k"]["tags"] == ["t"] and float(r.m["k"]["in"]["z"]) == 2e-7
    assert r.m["none"] is None and r.nil is None and r.nan is None and r.big is None


def test_objects_appear_whole_or_not_at_all(spark, tmpdir_path, monkeypatch):
    path = tmpdir_path + "/processed/a_summary.json"
    W.put_object(path, b"old")
    W.put_object("file:" + path, b"new")
    assert open(path, "rb").read() == b"new" and os.listdir(tmpdir_path + "/processed") == ["a_summary.json"]

    def killed(*_):
        raise KeyboardInterrupt
    monkeypatch.setattr(os, "replace", killed)
    try:
        W.put_object(path, b"half")
    except KeyboardInterrupt:
        pass
    assert open(path, "rb").read() == b"new" and os.listdir(tmpdir_path + "/processed") == ["a_summary.json"]
    monkeypatch.undo()
    docs = spark.sql("SELECT 'processed/x_summary.json' AS summary_key, map('c', 1.5D) AS stats, CAST(NULL AS STRING) AS none, DATE'2020-01-02' AS day")
    W.write_summaries(docs, tmpdir_path, exact_names=True)
    doc = json.load(open(tmpdir_path + "/processed/x_summary.json"))
    assert doc == {"summary_key": "processed/x_summary.json", "stats": {"c": 1.5}, "none": None, "day": "2020-01-02"}
