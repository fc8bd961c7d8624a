"""DuckDB oracle SQL for every registered query.

Each query is ``WITH <derived tables> <body>``; the derived tables are written
independently of the Spark code from the same definitions (SURVEY §7.4), and
DuckDB's regex engine is RE2, so the literal grammars are restated here with
ASCII whitespace (the test data holds no other whitespace).
"""

from __future__ import annotations

from tessera.functions.rounding import py_round_sql as R

INT_RE = r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$"
FLOAT_RE = (r"(?i)^\s*[+-]?(([0-9]+(_[0-9]+)*)(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)"
            r"(e[+-]?[0-9]+(_[0-9]+)*)?\s*$|^\s*[+-]?(nan|inf|infinity)\s*$")
DATE_CHECKS = [
    ("fmt_ymd_dash", r"[0-9]{4}-[0-9]{1,2}-([0-9]{1,2}| [1-9])", "%Y-%m-%d"),
    ("fmt_mdy_slash", r"[0-9]{1,2}/([0-9]{1,2}| [1-9])/[0-9]{4}", "%m/%d/%Y"),
    ("fmt_dmy_slash", r"([0-9]{1,2}| [1-9])/[0-9]{1,2}/[0-9]{4}", "%d/%m/%Y"),
    ("fmt_ymd_slash", r"[0-9]{4}/[0-9]{1,2}/([0-9]{1,2}| [1-9])", "%Y/%m/%d"),
]
DIRTY_COLUMNS = ["c_user", "c_value", "c_day", "c_us", "c_latebad", "c_mixed", "c_blank", "c_props"]


def _date_ok(col: str, fmt_re: str, fmt: str) -> str:
    no_year0 = f"NOT (starts_with({col}, '0000') OR ends_with({col}, '/0000'))"
    return (f"(regexp_full_match({col}, '{fmt_re}') AND {no_year0} "
            f"AND try_strptime(replace({col}, ' ', ''), '{fmt}') IS NOT NULL)")


CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, deps: tuple[str, ...] = ()) -> None:
    CTES[name] = (sql, deps)


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    parts = ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order)
    return f"WITH {parts}\n{body}"


# --------------------------------------------------------------------------
# Derived tables
# --------------------------------------------------------------------------
cte("dirty_events", """
SELECT event_type || '.csv' AS file_name, event_id AS row_no,
  CASE WHEN event_id % 11 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS c_user,
  CASE WHEN event_id % 13 = 0 THEN '  ' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS c_value,
  strftime(ts, '%Y-%m-%d') AS c_day,
  strftime(ts, '%m/%d/%Y') AS c_us,
  CASE WHEN event_id > 5000 AND event_id % 50 = 0 THEN 'bad' ELSE strftime(ts, '%Y-%m-%d') END AS c_latebad,
  CASE WHEN event_id % 97 = 0 THEN 'invalid' ELSE CAST(user_id AS VARCHAR) END AS c_mixed,
  '' AS c_blank,
  props AS c_props
FROM events""")

cte("cells", "\nUNION ALL\n".join(
    f"SELECT file_name, row_no, {i} AS ordinal, '{c}' AS \"column\", {c} AS value FROM dirty_events"
    for i, c in enumerate(DIRTY_COLUMNS, 1)), ("dirty_events",))

def define_profile_ctes(prefix: str, cells: str) -> None:
    """Register the profile CTEs ({prefix}cell_flags ... {prefix}col_stats) over a cells CTE."""
    cte(f"{prefix}cell_flags", f"""
SELECT *,
  CASE WHEN is_int THEN TRY_CAST(replace(trim(value), '_', '') AS DECIMAL(38,0)) END AS int_value,
  CASE WHEN is_float THEN TRY_CAST(replace(trim(value), '_', '') AS DOUBLE) END AS float_value
FROM (
  SELECT *, (NOT is_missing AND regexp_matches(value, '{INT_RE}')) AS is_int,
            (NOT is_missing AND regexp_matches(value, '{FLOAT_RE}')) AS is_float
  FROM (SELECT *, (value IS NULL OR regexp_matches(value, '^\\s*$')) AS is_missing FROM {cells})
)""", (cells,))

    cte(f"{prefix}date_probe", f"""
SELECT file_name, ordinal, count(*) AS probe_n,
  {", ".join(f"bool_and({_date_ok('value', r, f)}) AS {n}" for n, r, f in DATE_CHECKS)}
FROM (
  SELECT file_name, ordinal, value,
         row_number() OVER (PARTITION BY file_name, ordinal ORDER BY row_no) AS rn
  FROM {prefix}cell_flags WHERE NOT is_missing
) WHERE rn <= 10
GROUP BY file_name, ordinal""", (f"{prefix}cell_flags",))

    cte(f"{prefix}col_agg", f"""
SELECT file_name, ordinal, "column",
  count(*) AS n_rows,
  CAST(count_if(is_missing) AS BIGINT) AS n_missing,
  CAST(count_if(is_int) AS BIGINT) AS n_int,
  CAST(count_if(is_float) AS BIGINT) AS n_float,
  CAST(count_if(isnan(float_value)) AS BIGINT) AS n_nan,
  min(int_value) AS int_min, max(int_value) AS int_max, sum(int_value) AS int_sum,
  min(CASE WHEN NOT isnan(float_value) THEN float_value END) AS float_min,
  max(CASE WHEN NOT isnan(float_value) THEN float_value END) AS float_max,
  sum(CASE WHEN NOT isnan(float_value) THEN float_value END) AS float_sum
FROM {prefix}cell_flags GROUP BY file_name, ordinal, "column\"""", (f"{prefix}cell_flags",))

    cte(f"{prefix}col_profile", f"""
SELECT a.*, p.probe_n, {", ".join(f"p.{n}" for n, _, _ in DATE_CHECKS)},
  ({" OR ".join(f"p.{n}" for n, _, _ in DATE_CHECKS)}) AS date_ok,
  a.n_rows - a.n_missing AS n_present,
  CASE WHEN a.n_rows - a.n_missing = 0 THEN 'string'
       WHEN a.n_int = a.n_rows - a.n_missing THEN 'int'
       WHEN a.n_float = a.n_rows - a.n_missing THEN 'float'
       WHEN coalesce({" OR ".join(f"p.{n}" for n, _, _ in DATE_CHECKS)}, false) THEN 'date'
       ELSE 'string' END AS type
FROM {prefix}col_agg a LEFT JOIN {prefix}date_probe p USING (file_name, ordinal)""",
        (f"{prefix}col_agg", f"{prefix}date_probe"))

    cte(f"{prefix}col_stats", f"""
SELECT *,
  CASE WHEN type = 'int' THEN CAST(int_min AS DOUBLE) WHEN type = 'float' THEN float_min END AS stat_min,
  CASE WHEN type = 'int' THEN CAST(int_max AS DOUBLE) WHEN type = 'float' THEN float_max END AS stat_max,
  CASE WHEN type = 'int' THEN CAST(int_sum AS DOUBLE) / n_int
       WHEN type = 'float' AND n_float - n_nan > 0 THEN float_sum / (n_float - n_nan) END AS stat_avg,
  CASE WHEN type = 'int' THEN n_int WHEN type = 'float' THEN n_float END AS stat_count
FROM {prefix}col_profile""", (f"{prefix}col_profile",))


define_profile_ctes("", "cells")

cte("declared", """
SELECT * FROM (VALUES ('c_user', 'int'), ('c_value', 'float'), ('c_mixed', 'int'), ('c_props', 'int'),
                      ('c_day', 'float')) t("column", expected_type)""")

cte("col_invalid", """
SELECT s.file_name, s."column", d.expected_type,
  CASE WHEN d.expected_type = 'int' THEN s.n_present - s.n_int ELSE s.n_present - s.n_float END AS invalid_count,
  """ + R("(CASE WHEN d.expected_type = 'int' THEN s.n_present - s.n_int ELSE s.n_present - s.n_float END)"
              " / s.n_rows * 100", 2) + """ AS invalid_pct
FROM col_stats s JOIN declared d USING ("column")
WHERE (CASE WHEN d.expected_type = 'int' THEN s.n_present - s.n_int ELSE s.n_present - s.n_float END) > 0""",
    ("col_stats", "declared"))

cte("file_prof", """
SELECT s.file_name, max(n_rows) AS row_count, count(*) AS column_count,
  CAST(count_if(type IN ('int', 'float') AND stat_count > 0) AS BIGINT) AS n_numeric,
  CAST(count_if(n_missing > 0) AS BIGINT) AS n_missing_columns,
  CAST(count_if(i.invalid_count IS NOT NULL) AS BIGINT) AS n_invalid_columns,
  string_agg(s."column" || ':' || type, ',' ORDER BY ordinal) AS schema_text
FROM col_stats s LEFT JOIN col_invalid i ON s.file_name = i.file_name AND s."column" = i."column"
GROUP BY s.file_name""", ("col_stats", "col_invalid"))

# --------------------------------------------------------------------------
# Runs and two-arm comparison
# --------------------------------------------------------------------------
cte("runs", """
SELECT CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS arm,
  CAST(user_id % 6 + 1 AS BIGINT) AS level, event_id AS run_id, ts, value AS seconds,
  value + ((event_id % 7) - 2) / 10.0::DOUBLE AS total_seconds,
  event_type <> 'error' AS ok,
  CASE WHEN event_type <> 'error' THEN 'success' ELSE 'error' END AS status,
  CAST(CASE WHEN event_type <> 'error' THEN (user_id % 6 + 1) * 100 ELSE 0 END AS BIGINT) AS n_rows
FROM events""")


def timing_stats_sql(src: str, value: str, ok: str | None, keys: str = "arm, level") -> str:
    measured = f"CASE WHEN {ok} THEN {value} END" if ok else value
    where = f"WHERE {ok}" if ok else ""
    bkeys = ", ".join(f"b.{k.strip()}" for k in keys.split(","))
    return f"""
SELECT {bkeys}, b.count, {R("b.min", 3)} AS min, {R("b.max", 3)} AS max, {R("b.mean", 3)} AS mean,
  {R("p.median", 3)} AS median, {R("p.p90", 3)} AS p90, {R("p.p95", 3)} AS p95,
  CASE WHEN b.count > 0 THEN {R("coalesce(b.sd, 0)", 3)} END AS stdev
FROM (SELECT {keys}, count({measured}) AS count, min({measured}) AS min, max({measured}) AS max,
             avg({measured}) AS mean, stddev_samp({measured}) AS sd FROM {src} GROUP BY {keys}) b
LEFT JOIN (
  SELECT {keys},
    (max(CASE WHEN rk = floor((n + 1) / 2) THEN v END) + max(CASE WHEN rk = floor(n / 2) + 1 THEN v END)) / 2 AS median,
    max(CASE WHEN rk = floor(n * 0.9) + 1 THEN v END) AS p90,
    max(CASE WHEN rk = floor(n * 0.95) + 1 THEN v END) AS p95
  FROM (SELECT {keys}, {value} AS v, row_number() OVER (PARTITION BY {keys} ORDER BY {value}) AS rk,
               count(*) OVER (PARTITION BY {keys}) AS n FROM {src} {where})
  GROUP BY {keys}) p USING ({keys})"""


cte("run_stats", timing_stats_sql("runs", "seconds", "ok"), ("runs",))

cte("run_latency", """
SELECT arm, level, run_id, """ + R("greatest(0.0::DOUBLE, total_seconds - seconds)", 3) + """ AS latency
FROM runs WHERE ok""", ("runs",))

cte("latency_stats", timing_stats_sql("run_latency", "latency", None), ("run_latency",))

cte("levels", """
SELECT arm, level, n_runs, n_ok, n_ok >= n_runs * 0.8 AS success, """ + R("mean_s", 3) + """ AS proc_seconds, rows,
  """ + R("CASE WHEN coalesce(sec, 0) > 0 THEN rows / coalesce(sec, 0) ELSE 0 END", 1) + """ AS rows_per_sec,
  """ + R("CASE WHEN coalesce(sec, 0) > 0 THEN n_ok / coalesce(sec, 0) ELSE 0 END", 4) + """ AS files_per_sec,
  """ + R("n_ok / n_runs * 100", 2) + """ AS success_rate
FROM (SELECT arm, level, count(*) AS n_runs, CAST(count_if(ok) AS BIGINT) AS n_ok,
             sum(CASE WHEN ok THEN seconds END) AS sec, avg(CASE WHEN ok THEN seconds END) AS mean_s,
             CAST(sum(n_rows) AS BIGINT) AS rows
      FROM runs GROUP BY arm, level)""", ("runs",))

cte("cases", """
SELECT arm, test, pos, status, outcome, expected_status FROM (
  SELECT CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS arm,
    'case_' || CAST(user_id % 40 AS VARCHAR) AS test, event_id AS pos, event_type AS status,
    CASE WHEN event_type = 'error' THEN 'error' WHEN event_type = 'view' THEN 'timeout' ELSE 'success' END AS outcome,
    CASE WHEN user_id % 3 = 0 THEN 'error' ELSE 'success' END AS expected_status, user_id
  FROM events)
WHERE NOT (arm = 'b' AND user_id % 40 >= 35)""")

cte("first_cases", """
SELECT arm, test, min(pos) AS pos, arg_min(status, pos) AS status, arg_min(outcome, pos) AS outcome,
  arg_min(expected_status, pos) AS expected_status
FROM cases GROUP BY arm, test""", ("cases",))

cte("status_match", """
SELECT arm, test, pos, expected_status, outcome AS actual_status, outcome = expected_status AS match_strict,
  (outcome = expected_status) OR (outcome IN ('success', 'error') AND expected_status IN ('success', 'error'))
    AS match_lenient
FROM cases""", ("cases",))


def speedup_sql(a: str, b: str) -> tuple[str, str]:
    ratio = f"(CASE WHEN {a} = 0 OR {b} = 0 THEN NULL ELSE {b} / {a} END)"
    factor = R(f"CASE WHEN {ratio} > 1 THEN {ratio} ELSE 1 / {ratio} END", 1)
    direction = f"(CASE WHEN {ratio} IS NULL THEN 'n/a' WHEN {ratio} > 1 THEN 'faster' ELSE 'slower' END)"
    return factor, direction


def metric_cmp_sql(src: str, metrics: list[str], higher: list[str]) -> str:
    long = "\nUNION ALL\n".join(
        f"SELECT arm, level, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {src}" for m in metrics)
    lower = "metric NOT IN (" + ", ".join(f"'{h}'" for h in higher) + ")"
    d = "(CASE WHEN b_value <> 0 THEN (a_value - b_value) / b_value * 100 END)"
    return f"""
SELECT level, metric, a_value, b_value, {R(d, 1)} AS pct_diff,
  CASE WHEN {d} IS NULL THEN 'n/a' WHEN {d} > 10 THEN 'high' WHEN {d} < -10 THEN 'low' ELSE 'near' END AS band,
  {lower} AS lower_is_better,
  CASE WHEN a_value IS NULL OR b_value IS NULL THEN 'n/a'
       WHEN (CASE WHEN {lower} THEN a_value < b_value ELSE a_value > b_value END) THEN 'better'
       WHEN (CASE WHEN {lower} THEN a_value > b_value ELSE a_value < b_value END) THEN 'worse'
       ELSE 'same' END AS verdict
FROM (SELECT level, metric, value AS a_value FROM ({long}) WHERE arm = 'a') a
LEFT JOIN (SELECT level, metric, value AS b_value FROM ({long}) WHERE arm = 'b') b USING (level, metric)"""


# --------------------------------------------------------------------------
# CSV files written from events
# --------------------------------------------------------------------------
cte("events_files", """
SELECT event_type || '_' || CAST(user_id % 20 AS VARCHAR) AS file, event_type, event_id, user_id, value, ts,
  min(event_id) OVER (PARTITION BY event_type || '_' || CAST(user_id % 20 AS VARCHAR)) AS first_id
FROM events""")

cte("events_file_status", """
SELECT file || '.csv' AS file_name,
  CASE WHEN bad_utf8 OR n_short > 0 OR long_first THEN 'error' ELSE 'success' END AS status,
  CASE WHEN bad_utf8 THEN 'file is not valid UTF-8'
       WHEN n_short > 0 THEN 'a row has fewer fields than the header'
       WHEN long_first THEN 'the first row has more fields than the header' END AS error_message,
  CAST(CASE WHEN bad_utf8 OR n_short > 0 OR long_first THEN 0 ELSE n END AS BIGINT) AS row_count,
  n_short AS n_short_rows, n_long AS n_long_rows, long_first AS long_first_row, NOT bad_utf8 AS utf8_ok
FROM (SELECT file, count(*) AS n,
        CAST(count_if(event_type = 'error' AND event_id % 37 = 0) AS BIGINT) AS n_short,
        CAST(count_if((event_type = 'click' AND event_id % 41 = 0)
                      OR (event_type = 'purchase' AND event_id = first_id)) AS BIGINT) AS n_long,
        bool_or(event_id = first_id AND ((event_type = 'click' AND event_id % 41 = 0) OR event_type = 'purchase'))
          AS long_first,
        bool_or(event_type = 'signup' AND event_id % 53 = 0) AS bad_utf8
      FROM events_files GROUP BY file)""", ("events_files",))


def _csv_col(name: str, ordinal: int, typ: str, expr: str | None) -> str:
    if expr is None:
        stats = "CAST(NULL AS DOUBLE) AS stat_min, CAST(NULL AS DOUBLE) AS stat_max, " \
                "CAST(NULL AS DOUBLE) AS stat_avg, CAST(NULL AS BIGINT) AS stat_count"
    else:
        stats = (f"CAST(min({expr}) AS DOUBLE) AS stat_min, CAST(max({expr}) AS DOUBLE) AS stat_max, "
                 f"{R(f'avg({expr})', 6)} AS stat_avg, count(*) AS stat_count")
    return (f"SELECT file || '.csv' AS file_name, '{name}' AS \"column\", {ordinal} AS ordinal, '{typ}' AS type, "
            f"{stats}, CAST(0 AS BIGINT) AS n_missing FROM events_files GROUP BY file")


cte("events_csv_profile", "\nUNION ALL\n".join([
    _csv_col("event_id", 1, "int", "event_id"),
    _csv_col("user_id", 2, "int", "user_id"),
    _csv_col("value", 3, "float", "CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE)"),
    _csv_col("day", 4, "date", None),
    _csv_col("note", 5, "string", None),
]), ("events_files",))

# --------------------------------------------------------------------------
# Metadata and reconciliation (orders / lineitem)
# --------------------------------------------------------------------------
cte("metadata_records", """
SELECT 'file_' || CAST(o_custkey AS VARCHAR) || '.csv' AS file_name, o_orderdate AS processed_ts, o_orderkey AS seq,
  CASE WHEN o_orderstatus = 'P' THEN 'error' ELSE 'success' END AS status,
  CASE WHEN o_orderstatus = 'P' THEN 'order ' || CAST(o_orderkey AS VARCHAR) || ' failed' END AS error_message,
  o_orderkey % 1000 AS row_count
FROM orders""")

cte("meta_latest", """
SELECT file_name, strftime(processed_ts, '%Y-%m-%d %H:%M:%S') AS processed_ts, seq, status, error_message, row_count
FROM (SELECT *, row_number() OVER (PARTITION BY file_name ORDER BY processed_ts DESC, seq DESC) AS rn
      FROM metadata_records) WHERE rn = 1""", ("metadata_records",))

cte("arrivals", "SELECT o_orderkey AS object_id, o_orderdate AS arrive_ts, o_orderpriority AS priority FROM orders")

cte("completions", """
SELECT l_orderkey AS object_id, min(l_shipdate) AS done_ts,
  CASE WHEN bool_or(l_returnflag = 'R') THEN 'error' ELSE 'success' END AS status
FROM lineitem GROUP BY l_orderkey""")

cte("deadline_matches", """
SELECT a.object_id, CASE WHEN count(c.done_ts) > 0 THEN 'done' ELSE 'timeout' END AS status,
  count(c.done_ts) AS n_matches, strftime(min(c.done_ts), '%Y-%m-%d %H:%M:%S') AS first_done
FROM arrivals a
LEFT JOIN (SELECT l_orderkey AS object_id, l_shipdate AS done_ts FROM lineitem) c
  ON a.object_id = c.object_id AND c.done_ts >= a.arrive_ts AND c.done_ts <= a.arrive_ts + INTERVAL 30 DAY
GROUP BY a.object_id""", ("arrivals",))

cte("arm_stage_stats", "\nUNION ALL\n".join([
    "SELECT 'T_processing' AS stage, * FROM (" + timing_stats_sql("runs", "seconds", "ok", "arm") + ")",
    "SELECT 'T_total_pipeline' AS stage, * FROM (" + timing_stats_sql("runs", "total_seconds", "ok", "arm") + ")",
    "SELECT 'T_event_latency' AS stage, * FROM (" + timing_stats_sql("run_latency", "latency", None, "arm") + ")",
    "SELECT DISTINCT 'T_upload' AS stage, arm, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), "
    "CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) "
    "FROM runs",
]), ("runs", "run_latency"))


# --------------------------------------------------------------------------
# Every driver table profiled as text (one "file" per table)
# --------------------------------------------------------------------------
def _text(col: str, kind: str) -> str:
    if kind == "double":
        return f"CAST(CAST({col} AS DECIMAL(18,2)) AS VARCHAR)"
    if kind.startswith("timestamp"):
        return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"
    return f"CAST({col} AS VARCHAR)"


def table_cells_sql(tables: dict[str, list[tuple[str, str]]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS file_name, 0 AS row_no, {i} AS ordinal, '{c}' AS \"column\", {_text(c, k)} AS value FROM {t}"
        for t, cols in tables.items() for i, (c, k) in enumerate(cols, 1))


def typed_tables_sql(tables: dict[str, list[tuple[str, str]]]) -> str:
    """Oracle of the schema-aware profile: integer and floating columns typed
    directly; every other column inferred from its text (tbx_ profile CTEs)."""
    text = {t: [(i, c, k) for i, (c, k) in enumerate(cols, 1) if k not in ("int", "bigint", "double")]
            for t, cols in tables.items()}
    cells = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS file_name, 0 AS row_no, {i} AS ordinal, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value "
        f"FROM {t}" for t, cols in text.items() for i, c, _ in cols)
    cte("tbx_cells", cells)
    define_profile_ctes("tbx_", "tbx_cells")
    typed = []
    for t, cols in tables.items():
        for i, (c, k) in enumerate(cols, 1):
            if k in ("int", "bigint"):
                typed.append(
                    f"SELECT '{t}' AS file_name, '{c}' AS \"column\", {i} AS ordinal, "
                    f"CASE WHEN count({c}) > 0 THEN 'int' ELSE 'string' END AS type, "
                    f"count(*) - count({c}) AS n_missing, CAST(min({c}) AS DOUBLE) AS stat_min, "
                    f"CAST(max({c}) AS DOUBLE) AS stat_max, count({c}) AS stat_count FROM {t}")
            elif k == "double":
                v = f"CASE WHEN NOT isnan({c}) THEN {c} END"
                typed.append(
                    f"SELECT '{t}' AS file_name, '{c}' AS \"column\", {i} AS ordinal, "
                    f"CASE WHEN count({c}) > 0 THEN 'float' ELSE 'string' END AS type, "
                    f"count(*) - count({c}) AS n_missing, min({v}) AS stat_min, max({v}) AS stat_max, "
                    f"count({c}) AS stat_count FROM {t}")
    body = ("\nUNION ALL\n".join(typed) + "\nUNION ALL\n"
            'SELECT file_name, "column", ordinal, type, n_missing, stat_min, stat_max, stat_count FROM tbx_col_stats')
    return with_ctes(body, "tbx_col_stats")
