"""Run-result documents of two arms through the comparison operators, checked
against the comparison report the reference recorded (FIXTURES.md §8).
The numbers below are fixed values of the two recorded result files; the labels
of the arms and the names of the checks are this test's own."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tessera.operators import compare as C
from tessera.operators import runs as R
from tessera.sources import results as S


def stats(count, mn, mx, mean, median, p90, p95, sd):
    return dict(count=count, min=mn, max=mx, mean=mean, median=median, p90=p90, p95=p95, stdev=sd)


CASES = ["Empty File", "No Header", "Malformed CSV", "Single Column", "All Missing Values", "Oversized Row"]
EXPECTED = ["error", "error", "error", "success", "success", "success"]
ACTUAL = ["error", "success", "error", "success", "success", "success"]
# This test's own checks; nothing recorded.
CHECKS = ["check one", "check two", "check three", "check four"]


def doc(env, b, f, g, failures):
    return {
        "environment": env, "timestamp": "2025-11-30T00:00:00Z",
        "experiments": {
            "B_e2e_timing": {"num_runs": 20, "rows_per_file": 1000, "failures": failures,
                             **{k: stats(*v) for k, v in b.items()}},
            "D_failure_injection": {"test_cases": [
                {"test": t, "upload_success": True, "expected_status": e, "actual_status": a, "match": True}
                for t, e, a in zip(CASES, EXPECTED, ACTUAL)], "total_tests": 6, "matches": 6},
            "F_file_size_scaling": {"results": [
                {"rows": r, "file_size_kb": kb, "success": True, "processing_time": pt,
                 "throughput_rows_per_sec": tp} for r, kb, pt, tp in f]},
            "G_parallel_scaling": {"results": [
                {"parallel_level": n, "successful_uploads": n, "successful_processing": n,
                 "processing_time": pt, "processing_throughput": tp, "upload_throughput": ut}
                for n, pt, tp, ut in g]},
            "H_iam_fidelity": {"tests": [{"test": t, "expected": "yes", "actual": "yes", "matches": True}
                                         for t in CHECKS], "total_tests": 4, "matches": 4},
        },
    }


EMU = doc("emulator", {
    "T_upload": (20, 0.008, 0.035, 0.013, 0.013, 0.016, 0.035, 0.005),
    "T_event_latency": (20, 0.008, 0.036, 0.015, 0.014, 0.017, 0.036, 0.006),
    "T_processing": (20, 1.025, 2.109, 1.103, 1.036, 1.316, 2.109, 0.245),
    "T_total_pipeline": (20, 1.035, 2.146, 1.117, 1.049, 1.332, 2.146, 0.25)},
    [(100, 6.4, 1.027, 97.3), (500, 32.1, 1.037, 482.1), (1000, 64.3, 1.033, 968.5),
     (5000, 325.6, 1.035, 4832.2), (10000, 652.3, 1.047, 9551.1), (20000, 1325.1, 1.03, 19425.7)],
    [(1, 5.05, 0.2, 85.46), (5, 5.054, 0.99, 160.58), (10, 5.148, 1.94, 186.28), (20, 5.24, 3.82, 202.19),
     (50, 5.272, 9.48, 324.6), (100, 5.472, 18.27, 238.89)], 0)
CLOUD = doc("cloud", {
    "T_upload": (20, 0.078, 0.867, 0.144, 0.085, 0.296, 0.867, 0.181),
    "T_event_latency": (18, 0.078, 0.264, 0.096, 0.086, 0.101, 0.264, 0.042),
    "T_processing": (18, 1.062, 2.126, 1.59, 1.596, 2.11, 2.126, 0.532),
    "T_total_pipeline": (18, 1.148, 2.371, 1.686, 1.683, 2.216, 2.371, 0.545)},
    [(100, 6.4, 1.081, 92.5), (500, 32.1, 2.11, 237.0), (1000, 64.3, 1.071, 933.7),
     (5000, 325.6, 2.104, 2376.4), (10000, 652.3, 2.096, 4771.1), (20000, 1325.1, 2.103, 9510.8)],
    [(1, 5.03, 0.2, 12.57), (5, 5.177, 0.97, 20.09), (10, 5.332, 1.88, 30.07), (20, 5.656, 3.54, 26.31),
     (50, 6.668, 7.5, 28.23), (100, 8.264, 12.1, 64.72)], 2)


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("results")
    for name, content in (("experiments_emulator_1.json", EMU), ("experiments_cloud_1.json", CLOUD)):
        with open(os.path.join(d, name), "w") as f:
            json.dump(content, f, indent=2)
    res = S.read_results(spark, str(d))
    return S.with_arm(res, {"emulator": "a", "cloud": "b"}).cache()


def test_stage_speedups(results):
    st = S.stage_stats(results)
    a = st.where("arm = 'a'").select("stage", F.col("mean").alias("a"))
    b = st.where("arm = 'b'").select("stage", F.col("mean").alias("b"))
    factor, direction = C.speedup("a", "b")
    got = {r["stage"]: (r["f"], r["d"]) for r in a.join(b, "stage").select("stage", factor.alias("f"),
                                                                           direction.alias("d")).collect()}
    assert got == {"T_upload": (11.1, "faster"), "T_event_latency": (6.4, "faster"),
                   "T_processing": (1.4, "faster"), "T_total_pipeline": (1.5, "faster")}


def test_stage_metric_comparison(results):
    m = C.metric_comparison(S.stage_stats(results), keys=("stage",))
    row = m.where("stage = 'T_event_latency' AND metric = 'mean'").first()
    assert row["band"] == "low" and row["verdict"] == "better"
    assert m.count() == 4 * 8


def test_size_results(results):
    sizes = C.size_comparison(S.size_results(results))
    got = {r["level"]: r["speedup"] for r in sizes.collect()}
    assert got == {100: 1.1, 500: 2.0, 1000: 1.0, 5000: 2.0, 10000: 2.0, 20000: 2.0}
    avg = {r["arm"]: r["avg_rows_per_sec"] for r in R.avg_throughput(S.size_results(results)).collect()}
    assert avg == {"a": 5892.8, "b": 2986.9}
    nl = {r["arm"]: r["nonlinear"] for r in R.nonlinear_scaling(S.size_results(results)).collect()}
    assert nl == {"a": False, "b": False}


def test_parallel_scaling(results):
    eff = {r["arm"]: (r["efficiency"], r["sublinear"])
           for r in R.scaling_efficiency(S.parallel_results(results)).collect()}
    assert eff == {"a": (91.3, False), "b": (60.5, False)}
    lv = C.level_comparison(S.parallel_results(results))
    assert lv.count() == 6


def test_cases_and_divergences(results):
    d = S.failure_cases(results)
    assert C.divergences(d).count() == 0
    cases = {r["test"]: r["b_status"] for r in C.case_comparison(d).collect()}
    assert cases["No Header"] == "success"
    sm = C.status_match(d).where("arm = 'a'")
    agg = sm.agg(F.count_if("match_strict").alias("s"), F.count_if("match_lenient").alias("l")).first()
    assert (agg["s"], agg["l"]) == (5, 6)
    h = S.failure_cases(results, "H_iam_fidelity", "tests", "actual")
    assert C.divergences(h).count() == 0


def test_scalar_metric_listing(results):
    """Scalar fields become (keys, metric, value) rows; nested ones are skipped."""
    sizes = S.size_results(results)
    listing = S.scalar_metrics(sizes, ["arm", "level"], ["rows", "success", "proc_seconds", "rows_per_sec"])
    metrics = {r["metric"] for r in listing.collect()}
    assert metrics == {"rows", "proc_seconds", "rows_per_sec"}
    assert listing.count() == 2 * 6 * 3


def test_latest_per_environment(results):
    latest = S.latest_per_environment(results)
    assert sorted(r["environment"] for r in latest.collect()) == ["cloud", "emulator"]


def test_first_match_and_list_order(spark):
    """Duplicated sizes: the first result in list order wins (next(...));
    first/last results follow list order, not the size order."""
    rows = [("a", 0, 100, 100, True, 1.0, 100.0), ("a", 1, 500, 500, True, 2.0, 250.0),
            ("b", 0, 500, 500, True, 4.0, 125.0), ("b", 1, 100, 100, True, 3.0, 33.3),
            ("b", 2, 100, 100, True, 9.0, 11.1)]
    df = spark.createDataFrame(rows, "arm string, pos int, level bigint, rows bigint, success boolean, "
                                     "proc_seconds double, rows_per_sec double")
    sizes = {r["level"]: (r["a_seconds"], r["b_seconds"]) for r in C.size_comparison(df).collect()}
    assert sizes == {100: (1.0, 3.0), 500: (2.0, 4.0)}
    scal = sorted((r["level"], r["b_proc_seconds"]) for r in C.scalability(df).collect())
    assert scal == [(100, 3.0), (500, 4.0)]
    nl = {r["arm"]: (r["expected_time"], r["actual_time"]) for r in R.nonlinear_scaling(df).collect()}
    assert nl["b"] == (4.0 * 100 / 500, 9.0)  # first = pos 0 (500 rows), last = pos 2 (100 rows)


def test_zero_divisors_give_null(spark):
    """A zero first throughput, row count or level yields NULL, not an error."""
    df = spark.createDataFrame([("a", 0, 1, 0, True, 1.0, 0.0, 0.0), ("a", 1, 5, 0, True, 2.0, 0.0, 1.0),
                                ("a", 2, 9, 0, True, 3.0, 0.0, 2.0)],
                               "arm string, pos int, level bigint, rows bigint, success boolean, "
                               "proc_seconds double, rows_per_sec double, files_per_sec double")
    eff = R.scaling_efficiency(df).first()
    assert eff["efficiency"] is None and eff["sublinear"] is None
    nl = R.nonlinear_scaling(df).first()
    assert nl["expected_time"] is None and nl["nonlinear"] is None
