"""CSV files end to end: the failure-injection cases, own tables with every kind of
defect, and the edge cases of SURVEY §2.12, held against goldens computed by hand and
against Python's csv module."""

import csv
import io
import os
import random

import numpy as np
import pytest
from helpers import write_files

from pyspark.sql import functions as F

from tessera.sources import csv_blocks as B
from tessera.sources import csv_files as C

# Ten rows: a text where an int was meant, a blank number, a day that is no date.
SAMPLE = """station,level,flow,checked,river
North weir,41,120.25,2019-04-02,Ouse
Mill race,17,98.50,2019-04-09,Ouse
Old lock,dry,101.75,2019-05-14,Swale
Ferry pool,23,140.00,2019-06-01,Nidd
Abbey ford,36,87.25,2019-06-11,Swale
Long reach,29,,2019-07-07,Nidd
Stone arch,18,133.50,not checked,Ouse
Salt marsh,44,99.00,2019-08-20,Swale
High falls,31,150.75,2019-09-03,Nidd
Low bridge,27,110.00,2019-10-30,Ouse
"""

# Recorded outcomes belong to these inputs.
FAILURES = {
    "empty.csv": "",
    "no_header.csv": "1,2,3\n4,5,6\n",
    "malformed.csv": 'not,valid\ncsv"data,missing,quote\n',
    "single.csv": "name\nAlice\nBob\n",
    "all_missing.csv": "name,age,salary\n,,\n,,\n",
    "oversized.csv": "name,data\nAlice," + "x" * 100000 + "\n",
}


def run(spark, root, **options):
    manifest = C.list_files(spark, root)
    columns, files = C.profile_files(spark, manifest, **options)
    st = {r["file_name"]: r.asDict() for r in files.collect()}
    cols = {}
    for r in columns.orderBy("ordinal").collect():
        cols.setdefault(r["file_path"].rsplit("/", 1)[-1], {})[r["column"]] = r.asDict()
    return st, cols


def test_failure_injection(spark, tmpdir_path):
    write_files(tmpdir_path, FAILURES)
    st, cols = run(spark, tmpdir_path)
    assert st["empty.csv"]["status"] == "error"
    assert st["empty.csv"]["error_message"] == "CSV file is empty or has no data rows"
    assert st["no_header.csv"]["status"] == "success" and st["no_header.csv"]["row_count"] == 1
    assert [cols["no_header.csv"][c]["type"] for c in ("1", "2", "3")] == ["int", "int", "int"]
    assert st["malformed.csv"]["status"] == "error" and st["malformed.csv"]["long_first_row"]
    assert st["single.csv"]["status"] == "success" and st["single.csv"]["row_count"] == 2
    assert cols["single.csv"]["name"]["type"] == "string"
    am = cols["all_missing.csv"]
    assert st["all_missing.csv"]["row_count"] == 2
    assert all(am[c]["type"] == "string" and am[c]["n_missing"] == 2 for c in ("name", "age", "salary"))
    assert st["oversized.csv"]["status"] == "success" and st["oversized.csv"]["row_count"] == 1


def test_sample_table(spark, tmpdir_path):
    write_files(tmpdir_path, {"sample.csv": SAMPLE})
    st, cols = run(spark, tmpdir_path)
    c = cols["sample.csv"]
    assert st["sample.csv"]["status"] == "success" and st["sample.csv"]["row_count"] == 10
    assert {k: v["type"] for k, v in c.items()} == {
        "station": "string", "level": "string", "flow": "float", "checked": "string", "river": "string"}
    s = c["flow"]
    assert (s["stat_min"], s["stat_max"], s["stat_count"]) == (87.25, 150.75, 9)
    assert abs(s["stat_avg"] - 1041 / 9) < 1e-9
    assert s["n_missing"] == 1


def test_edge_cases(spark, tmpdir_path):
    files = {
        "short.csv": "a,b,c\n1,2,3\n4,5\n",
        "long_later.csv": "a,b\n1,2\n3,4,5\n",
        "header_only.csv": "a,b,c\n",
        "blank_lines.csv": "a,b\n1,2\n\n3,4\n",
        "dup.csv": "a,b,a\n1,x,2022-01-05\n",
        "bom.csv": "﻿id,v\n1,2\n",
        "bad_utf8.csv": b"a,b\n1,caf\xff\n",
        "literals.csv": "i,f,d,e,s\n1_000,1d,2022-1-5,22-01-05,2022-01- 5\n2,1e3,2022-02-28,2022-01-05,2022-02-28\n",
        "quoted.csv": 'a,b\n"x,y","q""r"\n',
    }
    write_files(tmpdir_path, files)
    st, cols = run(spark, tmpdir_path)
    assert st["short.csv"]["status"] == "error" and st["short.csv"]["n_short_rows"] == 1
    assert st["long_later.csv"]["status"] == "success" and st["long_later.csv"]["n_long_rows"] == 1
    assert st["header_only.csv"]["status"] == "error"
    assert st["blank_lines.csv"]["row_count"] == 2
    assert list(cols["dup.csv"]) == ["a", "b"] and cols["dup.csv"]["a"]["type"] == "date"
    assert cols["dup.csv"]["a"]["ordinal"] == 1
    assert "id" in cols["bom.csv"] and cols["bom.csv"]["id"]["type"] == "int"
    assert st["bad_utf8.csv"]["status"] == "error" and not st["bad_utf8.csv"]["utf8_ok"]
    lit = cols["literals.csv"]
    assert lit["i"]["type"] == "int" and lit["i"]["stat_max"] == 1000.0
    assert lit["f"]["type"] == "string"
    assert lit["d"]["type"] == "date" and lit["e"]["type"] == "string"
    assert lit["s"]["type"] == "date"  # strptime's %d accepts a space-padded day
    assert st["quoted.csv"]["status"] == "success" and st["quoted.csv"]["row_count"] == 1


def test_quoted_line_ends(spark, tmpdir_path):
    """In rows and in the header, without any option."""
    write_files(tmpdir_path, {"nl.csv": 'a,b\n"line1\nline2",2\n3,4\n', "head.csv": '"a\nb","c ""d"""\r\n1,2\r\n"x\r\n\r\ny",3\r\n'})
    st, cols = run(spark, tmpdir_path)
    assert st["nl.csv"]["status"] == "success" and st["nl.csv"]["row_count"] == 2
    assert cols["nl.csv"]["b"]["type"] == "int"
    assert st["head.csv"]["row_count"] == 2 and list(cols["head.csv"]) == ["a\nb", 'c "d"']


def random_csv(rng) -> str:
    """Quotes, separators and line ends in any order; some of it no valid CSV."""
    parts = ['"', '""', ",", "\n", "\r\n", "a", "bé", '","', '"\n"', "😀", " "]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))


def test_blocks_of_any_size_hold_the_records_of_the_csv_module(tmpdir_path):
    rng = random.Random(1)
    path = os.path.join(tmpdir_path, "x.csv")
    n_records = 0
    for _ in range(1500):
        text = random_csv(rng)
        raw = text.encode()
        with open(path, "wb") as f:
            f.write(raw)
        size = rng.randint(1, 15)
        n = max(1, -(-len(raw) // size))
        start, blocks = 0, []
        for b in range(n):
            blocks.append(B.read_block(path, b * size, (b + 1) * size if b < n - 1 else None, start, ","))
            with open(path, "rb") as f:
                f.seek(max(b * size - 1, 0))
                before = f.read(1)[0] if b else -1
                data = B._past_quotes(f, f.read(size))
            fixed, changes = B.transition(*B.odd_runs(np.frombuffer(data, np.uint8), before, ord(",")))
            start = changes if fixed else (start + changes) % 2
        assert b"".join(blocks) == raw
        want = list(csv.reader(io.StringIO(text)))
        assert [r for block in blocks for r in csv.reader(io.StringIO(block.decode()))] == want
        if want:
            assert next(csv.reader(io.StringIO(B.first_record(path, ",").decode()))) == want[0]
        n_records += len(want)
    assert n_records > 3000


@pytest.mark.parametrize("block_bytes", [7, 64, 1 << 20])
def test_profile_does_not_depend_on_the_blocks(spark, tmpdir_path, block_bytes):
    rng = random.Random(5)
    rows = [[rng.choice(["x", 'say "hi"', "two\nlines", "a,b", "é\r\n😀", ""]), str(rng.randint(-9, 99)), f"2020-01-{rng.randint(1, 28):02d}"] for _ in range(60)]
    out = io.StringIO()
    csv.writer(out).writerows([["te\nxt", "n", "day"], *rows])
    long_field = 'a,b\n1,"' + "x\n" * 500 + '"\n2,y\n'
    write_files(tmpdir_path, {"r.csv": out.getvalue(), "long.csv": long_field, "bad.csv": b"a,b\n" + b"1,2\n" * 30 + b"3,4,\xe9\n" + b"5,6\n" * 30,
                              "cut.csv": "a,b\n" + "é,ü\n" * 40, "lone.csv": 'a,b\n' + '1,"open\n' * 20})
    st, cols = run(spark, tmpdir_path, block_bytes=block_bytes)
    assert st["r.csv"]["row_count"] == 60 and st["long.csv"]["row_count"] == 2 and st["cut.csv"]["row_count"] == 40
    c = cols["r.csv"]
    numbers = [int(r[1]) for r in rows]
    assert {k: v["type"] for k, v in c.items()} == {"te\nxt": "string", "n": "int", "day": "date"}
    assert (c["n"]["stat_min"], c["n"]["stat_max"], c["n"]["stat_count"]) == (min(numbers), max(numbers), 60)
    assert c["te\nxt"]["n_missing"] == sum(not r[0].strip() for r in rows)
    # Bytes that are no UTF-8 in a surplus field of a long row.
    assert (st["bad.csv"]["error_message"], st["bad.csv"]["utf8_ok"], st["bad.csv"]["n_long_rows"]) == (C.MSG_UTF8, False, 1)
    want = list(csv.reader(io.StringIO('a,b\n' + '1,"open\n' * 20)))
    assert (st["lone.csv"]["status"], st["lone.csv"]["row_count"]) == ("success", len(want) - 1)


def test_large_object_is_read_by_several_tasks(spark, tmpdir_path):
    """Blocks of one object are rows of a DataFrame, dealt over the tasks."""
    write_files(tmpdir_path, {"big.csv": "a,b\n" + '1,"x\ny"\n' * 5000})
    headers = C.read_headers(C.list_files(spark, tmpdir_path))
    rows = B.read_rows(headers.where("width > 0"), block_bytes=4096)
    parts = rows.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert len(parts) > 3 and sum(r["count"] for r in parts) == 5000
    assert rows.select("row_no").distinct().count() == 5000


def test_integers_beyond_a_decimal(spark, tmpdir_path):
    """A2: least, greatest and mean of integers of any length; Python's own are the golden."""
    nines = "9" * 40
    values = {"mix.csv": ["1", nines], "neg.csv": ["-" + nines, "-" + "9" * 41, "5", "-0"], "under.csv": ["1_0" * 1 + "0" * 60, "+7", " 12 "],
              "sum.csv": ["9" * 38] * 30, "huge.csv": ["1" + "0" * 400, "2"]}
    write_files(tmpdir_path, {k: "v\n" + "\n".join(v) + "\n" for k, v in values.items()})
    _, cols = run(spark, tmpdir_path)
    for name, texts in values.items():
        numbers = [int(t) for t in texts]
        got = cols[name]["v"]
        assert got["type"] == "int" and (int(got["int_min"]), int(got["int_max"])) == (min(numbers), max(numbers)), name
        if name != "huge.csv":
            assert (got["stat_min"], got["stat_max"]) == (float(min(numbers)), float(max(numbers)))
            assert got["stat_avg"] == sum(numbers) / len(numbers), name
        else:
            assert got["stat_avg"] is None


def test_date_rule_looks_at_the_first_ten_present_values(spark, tmpdir_path):
    """Later values and blank ones do not matter; formats are judged one by one."""
    def table(values):
        return "v\n" + "".join(f'"{v}"\n' for v in values)
    day, us = "2020-01-02", "01/02/2020"
    cases = {"ten.csv": ([day] * 10 + ["x"], "date"), "nine.csv": ([day] * 9 + ["x"], "string"), "blank.csv": ([" "] * 5 + [day] * 10 + ["x"] * 3, "date"),
             "few.csv": ([day, "x"], "string"), "two.csv": ([us] * 5 + [day] * 5, "string"), "either.csv": (["01/02/2020"] * 9 + ["13/02/2020"], "date"),
             "late.csv": ([us] * 12 + ["31/12/2020"], "date"), "first.csv": (["x"] + [day] * 20, "string"), "number.csv": ([day] * 10 + ["5"], "date")}
    write_files(tmpdir_path, {k: table(v) for k, (v, _) in cases.items()})
    for block_bytes in (16, 1 << 20):
        _, cols = run(spark, tmpdir_path, block_bytes=block_bytes)
        assert {k: cols[k]["v"]["type"] for k in cases} == {k: t for k, (_, t) in cases.items()}


def test_exact_name_summaries_and_helpers(spark, tmpdir_path):
    """K1 with exact object names, S4 read-back, K4 decimal leaves, P1, P2, P7, P10."""
    import json
    import os

    from tessera.functions import derived as D
    from tessera.operators import profile as P
    from tessera.sinks import writers as W
    write_files(tmpdir_path + "/in", {"sample.csv": SAMPLE})
    manifest = C.list_files(spark, tmpdir_path + "/in")
    columns, files = C.profile_files(spark, manifest)
    per_file = P.file_profile(columns.withColumnRenamed("file_path", "file_name"))
    docs = P.summary_document(per_file.withColumn("file_name", D.last_segment("file_name")))
    W.write_summaries(docs, tmpdir_path + "/out", exact_names=True)
    path = os.path.join(tmpdir_path, "out", "processed", "sample_summary.json")
    doc = json.load(open(path))
    assert doc["row_count"] == 10 and doc["column_count"] == 5
    assert doc["schema"]["flow"] == "float" and doc["statistics"]["flow"]["count"] == 9
    assert doc["quality_issues"]["missing_values"]["flow"] == {"count": 1, "percentage": 10.0}
    assert doc["quality_issues"]["has_issues"] is True and doc["quality_issues"]["invalid_values"] == {}
    dec = W.to_decimal_leaves(spark.createDataFrame([(0.1, "x")], "v double, s string"), ["v"])
    assert str(dec.first()["v"]).startswith("0.1")
    row = spark.createDataFrame([("uploads/a/x.csv.csv", "e" * 300, 65843)], "k string, m string, n bigint").select(
        D.last_segment("k").alias("f"), D.summary_key(D.last_segment("k")).alias("sk"),
        D.truncate("m", 200).alias("t"), D.size_kb("n").alias("kb")).first()
    assert row["f"] == "x.csv.csv" and row["sk"] == "processed/x_summary.json"
    assert len(row["t"]) == 200 and row["kb"] == 64.3


def test_manifest_only_empty_files(spark, tmpdir_path):
    write_files(tmpdir_path, {"a.csv": "", "b.csv": ""})
    st, cols = run(spark, tmpdir_path)
    assert {k: v["status"] for k, v in st.items()} == {"a.csv": "error", "b.csv": "error"}
    assert cols == {}


def test_many_header_widths(spark, tmpdir_path):
    """36 distinct header widths in one plan."""
    files = {}
    for w in range(1, 37):
        header = ",".join(f"c{i}" for i in range(w))
        files[f"w{w:02d}.csv"] = header + "\n" + ",".join(str(i) for i in range(w)) + "\n"
    write_files(tmpdir_path, files)
    cols, files = C.profile_files(spark, C.list_files(spark, tmpdir_path))
    assert cols.count() == sum(range(1, 37))
    assert {r["status"] for r in files.collect()} == {"success"}


def test_duplicated_manifest_rows(spark, tmpdir_path):
    """A file listed twice (re-delivered arrival) is profiled once."""
    write_files(tmpdir_path, {"sample.csv": SAMPLE})
    manifest = C.list_files(spark, tmpdir_path)
    columns, files = C.profile_files(spark, manifest.unionByName(manifest))
    st = files.collect()
    assert len(st) == 1 and st[0]["row_count"] == 10
    assert {r["column"]: r["n_rows"] for r in columns.collect()}["flow"] == 10


def test_sample_with_declared_schema(spark, tmpdir_path):
    """Against a declared schema (level int) the sample has one
    invalid level (10.0 %); against the inferred schema there are none."""
    from tessera.operators import profile as P
    write_files(tmpdir_path, {"sample.csv": SAMPLE})
    columns, files = C.profile_files(spark, C.list_files(spark, tmpdir_path))
    declared = spark.createDataFrame([("level", "int"), ("flow", "float")], "column string, expected_type string")
    inv = {r["column"]: (r["invalid_count"], r["invalid_pct"], r["expected_type"])
           for r in P.profile_invalid(columns, declared, keys=["file_path"]).collect()}
    assert inv == {"level": (1, 10.0, "int")}
    assert P.profile_invalid(columns, None, keys=["file_path"]).count() == 0
    summary = P.file_profile(columns, declared, keys=["file_path"]).first()
    assert summary["invalid_values"]["level"]["count"] == 1 and summary["has_issues"]
    assert summary["missing_values"]["flow"]["percentage"] == 10.0


# Eight rows with the three defects of SAMPLE, and three rows with a blank int.
EIGHT = """plot,trees,yield,planted
A1,12,40.5,2016-02-01
A2,9,31.25,2016-02-08
A3,15,52.0,2016-03-01
B1,11,38.75,2016-03-15
B2,8,29.5,2017-01-20
B3,10,,2017-01-27
C1,14,47.25,unknown
C2,many,44.0,2017-02-10
"""

THREE = """day,crop,crates,weight
2018/09/01,pears,8,12.75
2018/09/02,plums,3,30.25
2018/09/03,pears,,21.5
"""


def test_documents_of_two_tables(spark, tmpdir_path):
    """Types, statistics and quality issues through the summary document."""
    from tessera.operators import profile as P
    write_files(tmpdir_path, {"eight.csv": EIGHT, "three.csv": THREE})
    columns, files = C.profile_files(spark, C.list_files(spark, tmpdir_path))
    per_file = P.file_profile(columns, keys=["file_path"]).withColumn(
        "file_name", F.element_at(F.split("file_path", "/"), -1))
    docs = {r["file_name"]: r.asDict(recursive=True) for r in P.summary_document(per_file).collect()}
    eight, three = docs["eight.csv"], docs["three.csv"]
    assert eight["schema"] == {"plot": "string", "trees": "string", "yield": "float", "planted": "string"}
    s = eight["statistics"]["yield"]
    assert (s["min"], s["max"], s["count"]) == (29.5, 52.0, 7) and abs(s["avg"] - 283.25 / 7) < 1e-9
    assert eight["quality_issues"]["missing_values"] == {"yield": {"count": 1, "percentage": 12.5}}
    assert three["row_count"] == 3 and three["summary_key"] == "processed/three_summary.json"
    assert three["schema"] == {"day": "date", "crop": "string", "crates": "int", "weight": "float"}
    q, p = three["statistics"]["crates"], three["statistics"]["weight"]
    assert (q["min"], q["max"], q["avg"], q["count"]) == (3.0, 8.0, 5.5, 2)
    assert (p["min"], p["max"], p["count"]) == (12.75, 30.25, 3) and abs(p["avg"] - 21.5) < 1e-9
    assert three["quality_issues"]["missing_values"] == {"crates": {"count": 1, "percentage": 33.33}}
    assert three["quality_issues"]["has_issues"] is True


def test_leading_blank_line_is_an_error(spark, tmpdir_path):
    """SURVEY §2.12 #6: a blank first line leaves no header, so the file is an error."""
    write_files(tmpdir_path, {"lead.csv": "\na,b\n1,2\n"})
    st, cols = run(spark, tmpdir_path)
    assert st["lead.csv"]["status"] == "error" and cols == {}


def test_short_row_error_wins_over_long_first_row(spark, tmpdir_path):
    """SURVEY §2.12 #5: with a long first row and a short later row, the short
    row's error is the one reported (the reference checks columns in order)."""
    write_files(tmpdir_path, {"both.csv": "a,b\n1,2,3\n4\n"})
    st, _ = run(spark, tmpdir_path)
    r = st["both.csv"]
    assert r["status"] == "error" and r["error_message"] == C.MSG_SHORT
    assert r["long_first_row"] and r["n_short_rows"] == 1


def test_one_bad_object_fails_no_other(spark, tmpdir_path):
    """Names that look like patterns or are hidden elsewhere, large fields, objects that
    are gone before the header or before the rows are read: each has its own status."""
    write_files(tmpdir_path, {
        "r[1].csv": "a,b\n1,2\n", "w{x}*.csv": "a,b\n1,2\n3,4\n", "_x.csv": "a,b\n1,2\n", ".y.csv": "a\n1\n", "a b%20.csv": "a\n1\n",
        "cr.csv": "a,b\r1,2\r", "wide.csv": "a," + "h" * 140_000 + "\n1,2\n", "crrow.csv": "a,b\n1\r2,3\n", "nul.csv": "a\n\0\n",
        "quoted.csv": 'a,b,c\n"' + "q" * 300_000 + '""z,"\n', "badhead.csv": b"a,b\xff\n1,2\n", "good.csv": "a,b\n1,2\n", "_SUCCESS": "",
    })
    manifest = C.list_files(spark, tmpdir_path)
    gone = spark.createDataFrame([("file:" + tmpdir_path + "/gone.csv", 10, None)], manifest.schema)
    _, files = C.profile_files(spark, manifest.unionByName(gone))
    st = {r["file_name"]: (r["status"], r["error_message"], r["row_count"]) for r in files.collect()}
    for name, rows in (("r[1].csv", 1), ("w{x}*.csv", 2), ("_x.csv", 1), (".y.csv", 1), ("a b%20.csv", 1), ("good.csv", 1), ("wide.csv", 1)):
        assert st[name] == ("success", None, rows), name
    # A lone carriage return is an error of the csv module, and so of the reference.
    assert st["cr.csv"] == ("error", C.MSG_HEADER, 0) and st["crrow.csv"] == ("error", C.MSG_ROW, 0)
    assert st["gone.csv"] == ("error", C.MSG_UNREADABLE, 0) and st["nul.csv"] == ("error", C.MSG_ROW, 0)
    assert st["badhead.csv"] == ("error", C.MSG_UTF8, 0) and st["quoted.csv"] == ("error", C.MSG_SHORT, 0)
    assert len(st) == 13
    # With the reference's field limit large fields are errors.
    _, files = C.profile_files(spark, manifest, field_limit=131_072)
    st = {r["file_name"]: r["error_message"] for r in files.collect()}
    assert st["wide.csv"] == C.MSG_HEADER and st["quoted.csv"] == C.MSG_ROW and st["good.csv"] is None


def test_object_that_vanishes_after_its_header(spark, tmpdir_path):
    write_files(tmpdir_path, {"a.csv": "a,b\n1,2\n", "b.csv": "a,b\n1,2\n"})
    manifest = C.list_files(spark, tmpdir_path)
    headers = C.read_headers(manifest).persist()
    assert headers.count() == 2
    os.rename(os.path.join(tmpdir_path, "a.csv"), os.path.join(tmpdir_path, "moved"))
    rows = {r["file_path"].rsplit("/", 1)[-1]: (r["failure"], r["fields"]) for r in B.read_rows(headers).collect()}
    assert rows == {"a.csv": (B.UNREADABLE, []), "b.csv": (None, ["1", "2"])}
    headers.unpersist()


def test_listing_goes_down_all_levels(spark, tmpdir_path):
    write_files(tmpdir_path, {"a.csv": "a\n", "x/b.csv": "", "x/y/c.csv": "a\n1\n", "x/y/d.txt": "", "x/y/.d.txt.crc": "", "z/_SUCCESS": ""})
    names = {r["file_path"].replace("file:" + tmpdir_path + "/", ""): r["length"] for r in C.list_files(spark, tmpdir_path).collect()}
    assert names == {"a.csv": 2, "x/b.csv": 0, "x/y/c.csv": 4}
    assert C.list_files(spark, "file:" + tmpdir_path, suffix=None).count() == 4
