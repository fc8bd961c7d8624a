"""Two-arm comparison.

Arms are values of an ``arm`` column (default ``'a'`` vs ``'b'``).  Inputs
are per-level / per-case aggregates, so the joins here are between small,
already-aggregated tables; Catalyst/AQE choose broadcast from real sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.rounding import py_round, py_round_sql
from tessera.operators.ranking import dedupe_first

BAND_PCT = 10.0  # fixed value: +-10 % separates "high" / "low" from "near"


def _arm(df: DataFrame, arm: str, cols: Sequence[str], prefix: str, keys: Sequence[str],
         first_only: bool = False) -> DataFrame:
    """One arm's rows, columns prefixed.  With ``first_only`` and a list
    position ``pos``, only the first row per key is kept (``next(...)``)."""
    rows = df.where(F.col("arm") == arm)
    if first_only and "pos" in df.columns:
        rows = dedupe_first(rows.select(*keys, "pos", *cols), list(keys), "pos")
    return rows.select(*keys, *[F.col(c).alias(f"{prefix}_{c}") for c in cols])


def speedup(a: str, b: str) -> tuple[F.Column, F.Column]:
    """P11 on columns ``a``, ``b``: ratio b / a ("a is N x faster" when > 1,
    else 1/ratio "slower"); NULL / 'n/a' when either side is 0 or missing;
    exactly 1 counts as slower.  Returns (factor rounded to 1, direction)."""
    ratio = f"(CASE WHEN `{a}` = 0 OR `{b}` = 0 THEN NULL ELSE CAST(`{b}` AS DOUBLE) / `{a}` END)"
    factor = F.expr(py_round_sql(f"CASE WHEN {ratio} > 1 THEN {ratio} ELSE 1 / {ratio} END", 1, "spark"))
    direction = F.expr(f"CASE WHEN {ratio} IS NULL THEN 'n/a' WHEN {ratio} > 1 THEN 'faster' ELSE 'slower' END")
    return factor, direction


def pct_diff(a, b) -> tuple[F.Column, F.Column]:
    """(a - b) / b * 100 and its band; base 0 -> NULL / 'n/a'."""
    d = F.when(b != 0, (a - b) / b * 100)
    band = (F.when(d.isNull(), F.lit("n/a")).when(d > BAND_PCT, F.lit("high"))
            .when(d < -BAND_PCT, F.lit("low")).otherwise(F.lit("near")))
    return d, band


def verdict(a, b, lower_is_better) -> F.Column:
    """Which arm is better on a metric, by its direction."""
    better = F.when(lower_is_better, a < b).otherwise(a > b)
    worse = F.when(lower_is_better, a > b).otherwise(a < b)
    return (F.when(a.isNull() | b.isNull(), F.lit("n/a")).when(better, F.lit("better"))
            .when(worse, F.lit("worse")).otherwise(F.lit("same")))


def key_union(levels: DataFrame, key: str = "level", arm_a: str = "a", arm_b: str = "b") -> DataFrame:
    """Sorted union of the keys both arms report."""
    a = levels.where(F.col("arm") == arm_a).select(key)
    b = levels.where(F.col("arm") == arm_b).select(key)
    return a.union(b).distinct()


def size_comparison(levels: DataFrame, key: str = "level", arm_a: str = "a", arm_b: str = "b",
                    keep_one_sided: bool = False) -> DataFrame:
    """Full outer join by key; both present and both successful -> times
    and speedup; both present otherwise -> success flags only; present on one
    side -> dropped (kept with ``keep_one_sided``)."""
    cols = ["success", "proc_seconds", "rows_per_sec"]
    j = _arm(levels, arm_a, cols, "a", [key], True).join(_arm(levels, arm_b, cols, "b", [key], True), key, "full")
    both = F.col("a_success").isNotNull() & F.col("b_success").isNotNull()
    if not keep_one_sided:
        j = j.where(both)
    ok = F.coalesce(F.col("a_success") & F.col("b_success"), F.lit(False))
    factor, direction = speedup("a_proc_seconds", "b_proc_seconds")
    return j.select(
        key, "a_success", "b_success",
        F.when(ok, F.col("a_proc_seconds")).alias("a_seconds"),
        F.when(ok, F.col("b_proc_seconds")).alias("b_seconds"),
        F.when(ok, factor).alias("speedup"),
        F.when(ok, direction).otherwise(F.lit("n/a")).alias("direction"))


def level_comparison(levels: DataFrame, key: str = "level", arm_a: str = "a", arm_b: str = "b") -> DataFrame:
    """Full outer join by level; each side's throughput and success rate
    when present (NULL otherwise)."""
    cols = ["files_per_sec", "rows_per_sec", "success_rate"]
    return (_arm(levels, arm_a, cols, "a", [key], True)
            .join(_arm(levels, arm_b, cols, "b", [key], True), key, "full"))


def scalability(levels: DataFrame, key: str = "level", arm_a: str = "a", arm_b: str = "b") -> DataFrame:
    """Every successful row of arm a left-joined to arm b's first
    successful row of the same key (b's success predicate applied before the
    join)."""
    cols = ["proc_seconds", "rows_per_sec"]
    a = _arm(levels.where("success"), arm_a, cols, "a", [key])
    b = _arm(levels.where("success"), arm_b, cols, "b", [key], True)
    return a.join(b, key, "left")


def metric_comparison(stats: DataFrame, keys: Sequence[str] = ("level",),
                      metrics: Sequence[str] = ("count", "min", "max", "mean", "median", "p90", "p95", "stdev"),
                      higher_is_better: Sequence[str] = ("count",),
                      arm_a: str = "a", arm_b: str = "b") -> DataFrame:
    """J5 + P12 + P13: unpivot both arms' stat records to (keys, metric,
    value), every record of arm a with that of arm b, percent difference, band and
    verdict.  Both arms come from one pass over the records."""
    keys = list(keys)
    long = stats.select("arm", *keys, *[F.col(m).cast("double").alias(m) for m in metrics]) \
        .unpivot(["arm", *keys], list(metrics), "metric", "value")
    def value(arm: str):
        return F.max(F.when(F.col("arm") == arm, F.col("value")))

    j = long.groupBy(*keys, "metric").agg(value(arm_a).alias("a_value"), value(arm_b).alias("b_value"),
                                          F.bool_or(F.col("arm") == arm_a).alias("_a"))
    j = j.where("_a").drop("_a")
    d, band = pct_diff(F.col("a_value"), F.col("b_value"))
    lower = ~F.col("metric").isin(*higher_is_better)
    j = j.select("*", d.alias("_d"), band.alias("band"), lower.alias("lower_is_better"))
    return j.select(*keys, "metric", "a_value", "b_value", py_round("_d", 1).alias("pct_diff"),
                    "band", "lower_is_better",
                    verdict(F.col("a_value"), F.col("b_value"), F.col("lower_is_better")).alias("verdict"))


def throughput_pct_diff(levels: DataFrame, key: str = "level", arm_a: str = "a", arm_b: str = "b") -> DataFrame:
    """P12/P19 over the scalar metrics of per-level results."""
    return metric_comparison(levels, [key], ("files_per_sec", "rows_per_sec", "proc_seconds", "success_rate"),
                             ("files_per_sec", "rows_per_sec", "success_rate"), arm_a, arm_b)


def first_cases(cases: DataFrame) -> DataFrame:
    """First case per (arm, test) by position."""
    return dedupe_first(cases, ["arm", "test"], "pos")


def _b_first(cases: DataFrame, arm_b: str) -> DataFrame:
    b = cases.where(F.col("arm") == arm_b).select("test", "pos", "status")
    return dedupe_first(b, ["test"], "pos").select("test", F.col("status").alias("b_status"))


def case_comparison(cases: DataFrame, arm_a: str = "a", arm_b: str = "b") -> DataFrame:
    """Every case of arm a (in list position ``pos``) with the status of
    arm b's first case of the same name; 'N/A' when b has none."""
    a = cases.where(F.col("arm") == arm_a).select("test", "pos", F.col("status").alias("a_status"))
    j = a.join(_b_first(cases, arm_b), "test", "left")
    b_status = F.coalesce("b_status", F.lit("N/A"))
    return j.select("test", "pos", "a_status", b_status.alias("b_status"), (F.col("a_status") == b_status).alias("same"))


def divergences(cases: DataFrame, arm_a: str = "a", arm_b: str = "b") -> DataFrame:
    """Cases of arm a whose test also ran in arm b (first match) with a
    different status."""
    a = cases.where(F.col("arm") == arm_a).select("test", "pos", F.col("status").alias("a_status"))
    return a.join(_b_first(cases, arm_b), "test", "inner").where(F.col("a_status") != F.col("b_status"))


def status_match(cases: DataFrame, actual_col: str = "outcome", expected_col: str = "expected_status") -> DataFrame:
    """F11 per executed case: strict equality, and the lenient rule under which
    any of success/error matches any expectation of success/error."""
    act, exp = F.col(actual_col), F.col(expected_col)
    strict = act == exp
    terminal = act.isin("success", "error") & exp.isin("success", "error")
    return cases.select("arm", "test", "pos", exp.alias("expected_status"), act.alias("actual_status"),
                        strict.alias("match_strict"), (strict | terminal).alias("match_lenient"))


def insight_flags(stats: DataFrame, latency_stats: DataFrame, key: str = "level",
                  arm_a: str = "a", arm_b: str = "b", fast_seconds: float = 5.0) -> DataFrame:
    """a's mean under 5 s, a slower than b, b's event latency over twice a's."""
    s = _arm(stats, arm_a, ["mean"], "a", [key]).join(_arm(stats, arm_b, ["mean"], "b", [key]), key, "full")
    lat = (_arm(latency_stats, arm_a, ["mean"], "a_lat", [key])
           .join(_arm(latency_stats, arm_b, ["mean"], "b_lat", [key]), key, "full"))
    j = s.join(lat, key, "full")
    return j.select(
        key, "a_mean", "b_mean",
        (F.col("a_mean") < fast_seconds).alias("fast_iteration"),
        (F.col("a_mean") > F.col("b_mean")).alias("a_slower"),
        (F.col("b_lat_mean") > F.col("a_lat_mean") * 2).alias("latency_gap"))


def total_speedup(runs: DataFrame, value_col: str = "total_seconds", arm_a: str = "a", arm_b: str = "b") -> DataFrame:
    """Speedup of the two arms on mean total time of successful runs."""
    m = runs.where("ok").groupBy().agg(
        F.avg(F.when(F.col("arm") == arm_a, F.col(value_col))).alias("a_mean"),
        F.avg(F.when(F.col("arm") == arm_b, F.col(value_col))).alias("b_mean"))
    factor, direction = speedup("a_mean", "b_mean")
    return m.select(py_round("a_mean", 3).alias("a_mean"), py_round("b_mean", 3).alias("b_mean"),
                    factor.alias("speedup"), direction.alias("direction"))
