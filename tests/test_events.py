"""Arrival notifications: every record, URL-decoded keys, routing, manifest."""

import json

from tessera.sources import events as E


def note(*records):
    return json.dumps({"Records": [
        {"eventName": n, "eventTime": "2025-11-30T00:00:00.000Z",
         "s3": {"bucket": {"name": "bkt"}, "object": {"key": k, "size": s}}} for n, k, s in records]})


def test_decode_route_manifest(spark):
    bodies = [note(("ObjectCreated:Put", "uploads/a+b.csv", 10), ("ObjectRemoved:Delete", "uploads/c.csv", 0)),
              note(("ObjectCreated:Put", "other/x.csv", 5)),
              note(("ObjectCreated:Put", "uploads/y.txt", 5)),
              note(("ObjectCreated:Copy", "uploads/sub%20dir/z.csv", 7), ("ObjectCreated:Put", "uploads/p%ZZ.csv", 1))]
    raw = spark.createDataFrame([(b,) for b in bodies], "body string")
    routed = E.route(E.decode_events(raw))
    got = sorted((r["key"], r["file_name"], r["action"]) for r in routed.collect())
    assert got == sorted([
        ("uploads/a b.csv", "a b.csv", "process"), ("uploads/c.csv", "c.csv", "ignored"),
        ("other/x.csv", "x.csv", "skipped"), ("uploads/y.txt", "y.txt", "ignored"),
        ("uploads/sub dir/z.csv", "z.csv", "process"), ("uploads/p%ZZ.csv", "p%ZZ.csv", "process")])
    man = {r["file_path"]: r["length"] for r in E.manifest_from_events(routed).collect()}
    assert man == {"s3a://bkt/uploads/a b.csv": 10, "s3a://bkt/uploads/sub dir/z.csv": 7,
                   "s3a://bkt/uploads/p%ZZ.csv": 1}
    local = {r["file_path"] for r in E.manifest_from_events(routed, "file:/data/").collect()}
    assert "file:/data/uploads/a b.csv" in local
