"""Column and file profiling over the long ``cells`` form.

Plan shape: one scan of the cells.  Project(flags, parsed values) -> partial
HashAggregate -> Exchange on (file, ordinal, column) -> final HashAggregate.  Partial
aggregation collapses each task's cells to one row per (file, column), so a file that
holds a third of all rows costs no more shuffle than a small one.

The date type is decided on the first ten present values of a column in row order
(N1, the reference's own rule).  The aggregation keeps, for each date format, the first
row that does not fit it: where there is none the format holds, and where it is the
first present row it does not.  Only columns that change in between, and columns whose
integers do not fit a decimal, are looked at again, one more aggregation of their cells
alone.  Every count is exact; nothing is sampled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.derived import iso_utc, summary_key
from tessera.functions.predicates import (
    DATE_FORMATS,
    FLOAT_CAPTURE,
    INT_CAPTURE,
    is_date_format,
    is_missing,
    may_be_date,
    may_be_number,
)
from tessera.functions.rounding import py_round
from tessera.operators.integers import exact_integers
from tessera.session import shared_dir

DATE_PROBE_SIZE = 10  # fixed value: the reference looks at the first 10 values
DATE_FLAG_NAMES = ["fmt_ymd_dash", "fmt_mdy_slash", "fmt_dmy_slash", "fmt_ymd_slash"]
# Union of the four date shapes: a value outside it parses under no format.
DATE_SHAPE_ANY = "^(?:" + "|".join(dict.fromkeys(shape[1:-1] for _, _, shape in DATE_FORMATS)) + ")$"


def cell_flags(cells: DataFrame, keys: Sequence[str] = ("file_name",)) -> DataFrame:
    """Per-cell predicate flags and parsed numeric values.

    One capturing regex per numeric type validates the literal and strips its
    whitespace at once; the float regex is skipped for int literals, and the
    casts only ever see validated text (no parse failures on the hot path).
    """
    v = F.col("value")
    flagged = cells.select("*", is_missing(v).alias("is_missing"), may_be_number(v).alias("_num"))
    present = ~F.col("is_missing")
    flagged = flagged.select("*", F.when(present & F.col("_num"), F.regexp_extract(v, INT_CAPTURE, 1))
                             .alias("_int_txt"))
    is_int = F.coalesce(F.col("_int_txt") != "", F.lit(False))
    flagged = flagged.select(
        "*", F.when(is_int, F.col("_int_txt"))
        .when(present & F.col("_num"), F.regexp_extract(v, FLOAT_CAPTURE, 1)).alias("_flt_txt"))
    is_float = F.coalesce(F.col("_flt_txt") != "", F.lit(False))
    return flagged.select(
        *[c for c in flagged.columns if c not in ("_int_txt", "_flt_txt", "_num")],
        is_int.alias("is_int"),
        is_float.alias("is_float"),
        F.when(is_int, F.replace(F.col("_int_txt"), F.lit("_"), F.lit("")).try_cast("decimal(38,0)"))
        .alias("int_value"),
        F.when(is_float, F.replace(F.col("_flt_txt"), F.lit("_"), F.lit("")).try_cast("double"))
        .alias("float_value"),
    )


FIRST_FAILURES = [f"_fail_{name}" for name in DATE_FLAG_NAMES]


def date_flags(flags: DataFrame) -> DataFrame:
    """``flags`` (of ``cell_flags``) with one flag per date format (F4).  Numeric literals
    are never date-shaped, and the formats are tried on date-shaped values alone."""
    shaped = (~F.col("is_missing") & ~F.col("is_int") & ~F.col("is_float") & may_be_date("value")
              & F.col("value").rlike(DATE_SHAPE_ANY))
    flags = flags.select("*", shaped.alias("_shaped"))
    return flags.select("*", *[(F.col("_shaped") & is_date_format("value", i)).alias(name)
                               for i, name in enumerate(DATE_FLAG_NAMES)]).drop("_shaped")


def _undecided(each_format: bool) -> Column:
    """Columns of which some date format fits the first present value but not all, and,
    unless each format is asked for, no format fits all."""
    some, whole = F.lit(False), F.lit(False)
    for fail in FIRST_FAILURES:
        some = some | F.coalesce(F.col(fail) > F.col("_first_present"), F.lit(False))
        whole = whole | F.col(fail).isNull()
    return (F.col("n_present") > DATE_PROBE_SIZE) & some & (F.lit(each_format) | ~whole)


def _probe(cells: DataFrame, undecided: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per undecided column, for each format the number of present values before the
    first one that it does not fit."""
    on = [*keys, "ordinal"]
    last = F.greatest(*FIRST_FAILURES)
    rows = cells.join(undecided.select(*on, *FIRST_FAILURES, last.alias("_last")), on)
    rows = rows.where(~is_missing("value") & (F.col("row_no") < F.col("_last")))
    return rows.groupBy(*on).agg(*[F.count_if(F.col("row_no") < F.col(fail)).alias(f"_before_{name}")
                                   for fail, name in zip(FIRST_FAILURES, DATE_FLAG_NAMES)])


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: the cells are read once for it."""
    path = shared_dir(df.sparkSession, "profile", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column_profile(cells: DataFrame, keys: Sequence[str] = ("file_name",),
                   extra_aggs: Sequence[F.Column] = (), each_format: bool = False) -> DataFrame:
    """One row per (file, column): counts, inferred type and statistics.

    Output columns: keys, ordinal, column, n_rows, n_missing, n_present, n_int,
    n_float, n_nan, type, stat_min, stat_max, stat_avg, stat_count, int_min, int_max
    (exact, decimal digits as text), probe_n, date_ok, with ``each_format`` a flag for
    each date format, then ``extra_aggs`` (further aggregates over the same cells,
    computed in the same pass).

    ``row_no`` gives the order of a file's rows.  The cells are read when this is
    called, once; a second time only for the few columns that need it, if any.
    """
    keys = list(keys)
    flags = date_flags(cell_flags(cells, keys))
    fv_num = F.when(~F.isnan("float_value"), F.col("float_value"))
    present = ~F.col("is_missing")
    # ``column`` is a grouping key, not an any_value() aggregate: a string
    # aggregation buffer would push Spark off the fixed-width hash aggregate.
    aggs = {
        "n_rows": F.count(F.lit(1)),
        "n_missing": F.count_if("is_missing"),
        "n_int": F.count_if("is_int"),
        "n_float": F.count_if("is_float"),
        "n_nan": F.count_if(F.isnan("float_value")),
        "_n_wide": F.count_if(F.col("is_int") & F.col("int_value").isNull()),
        "_int_min": F.min("int_value"),
        "_int_max": F.max("int_value"),
        "_int_sum": F.try_sum("int_value"),
        "_float_min": F.min(fv_num),
        "_float_max": F.max(fv_num),
        "_float_sum": F.sum(fv_num),
        "_first_present": F.min(F.when(present, F.col("row_no"))),
        **{fail: F.min(F.when(present & ~F.col(name), F.col("row_no")))
           for fail, name in zip(FIRST_FAILURES, DATE_FLAG_NAMES)},
    }
    agg = flags.groupBy(*keys, "ordinal", "column").agg(*[c.alias(n) for n, c in aggs.items()], *extra_aggs)
    extra_names = agg.columns[len(keys) + 2 + len(aggs):]
    agg = _kept(agg.withColumn("n_present", F.col("n_rows") - F.col("n_missing")), "columns")
    on = [*keys, "ordinal"]
    undecided = agg.where(_undecided(each_format))
    last = undecided.agg(F.max(F.greatest(*FIRST_FAILURES))).first()[0]
    if last is None:
        agg = agg.select("*", *[F.lit(None).cast("bigint").alias(f"_before_{name}") for name in DATE_FLAG_NAMES])
    else:
        agg = agg.join(_probe(cells.where(F.col("row_no") < F.lit(last)), undecided, keys), on, "left")
    wide = agg.where((F.col("n_int") == F.col("n_present")) & (F.col("n_int") > 0)
                     & ((F.col("_n_wide") > 0) | F.col("_int_sum").isNull()))
    if wide.isEmpty():
        none = F.lit(None)
        agg = agg.select("*", none.cast("string").alias("wide_min"), none.cast("string").alias("wide_max"),
                         none.cast("double").alias("wide_avg"))
    else:
        agg = agg.join(exact_integers(cells.join(wide.select(*on), on, "left_semi"), on), on, "left")
    prof = _resolved(agg, keys, extra_names)
    return prof if each_format else prof.drop(*DATE_FLAG_NAMES)


def _resolved(agg: DataFrame, keys: Sequence[str], extra_names: Sequence[str]) -> DataFrame:
    """Types and statistics from the aggregates of ``column_profile``."""
    some = F.col("n_present") > 0
    fits = [F.col(fail).isNull() | F.coalesce(F.col(f"_before_{name}") >= DATE_PROBE_SIZE, F.lit(False))
            for fail, name in zip(FIRST_FAILURES, DATE_FLAG_NAMES)]
    prof = agg.select("*", F.when(some, F.least(F.lit(DATE_PROBE_SIZE).cast("bigint"), F.col("n_present"))).alias("probe_n"),
                      *[F.when(some, ok).alias(name) for ok, name in zip(fits, DATE_FLAG_NAMES)])
    any_fmt = F.col(DATE_FLAG_NAMES[0])
    for name in DATE_FLAG_NAMES[1:]:
        any_fmt = any_fmt | F.col(name)
    prof = prof.withColumn("date_ok", any_fmt)
    ctype = (
        F.when(~some, F.lit("string"))
        .when(F.col("n_int") == F.col("n_present"), F.lit("int"))
        .when(F.col("n_float") == F.col("n_present"), F.lit("float"))
        .when(F.coalesce(F.col("date_ok"), F.lit(False)), F.lit("date"))
        .otherwise(F.lit("string"))
    )
    prof = prof.withColumn("type", ctype)
    is_int_t = F.col("type") == "int"
    is_flt_t = F.col("type") == "float"
    n_finite = F.col("n_float") - F.col("n_nan")
    least = F.coalesce("wide_min", F.col("_int_min").cast("string"))
    most = F.coalesce("wide_max", F.col("_int_max").cast("string"))
    # A column with a wide value has its average from exact_integers alone (null: beyond a double).
    avg = F.when(F.col("wide_min").isNotNull(), F.col("wide_avg")).otherwise(F.col("_int_sum").cast("double") / F.col("n_int"))
    return prof.select(
        *keys, "ordinal", "column", "n_rows", "n_missing", "n_present", "n_int", "n_float",
        "n_nan", "type",
        F.when(is_int_t, least.cast("double")).when(is_flt_t, F.col("_float_min")).alias("stat_min"),
        F.when(is_int_t, most.cast("double")).when(is_flt_t, F.col("_float_max")).alias("stat_max"),
        F.when(is_int_t, avg).when(is_flt_t & (n_finite > 0), F.col("_float_sum") / n_finite).alias("stat_avg"),
        F.when(is_int_t, F.col("n_int")).when(is_flt_t, F.col("n_float")).alias("stat_count"),
        F.when(is_int_t, least).alias("int_min"),
        F.when(is_int_t, most).alias("int_max"),
        "probe_n", *DATE_FLAG_NAMES, "date_ok", *extra_names,
    )


def pct(n, total) -> F.Column:
    """Percentage of total, 2 decimals, rounded like Python (``n``/``total``
    are column names or Columns; prefer names, which build one SQL call)."""
    if isinstance(n, str) and isinstance(total, str):
        return py_round(F.col(n) / F.col(total) * 100, 2)
    return py_round(n / total * 100, 2)


def _pct_cols(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Add raw percentage columns name -> (count, total), then their rounded value."""
    raw = df.select("*", *[(F.col(n) / F.col(t) * 100).alias(f"_{name}_raw") for name, (n, t) in pairs.items()])
    return raw.select(*df.columns, *[py_round(f"_{name}_raw", 2).alias(name) for name in pairs])


# ---------------------------------------------------------------------------
# Views over a column profile.  ``prof`` is the output of column_profile.
# ---------------------------------------------------------------------------

def profile_schema(prof: DataFrame, keys: Sequence[str] = ("file_name",)) -> DataFrame:
    """A1: inferred type per column."""
    return prof.select(*keys, "ordinal", "column", "type")


def profile_stats(prof: DataFrame, keys: Sequence[str] = ("file_name",)) -> DataFrame:
    """A2: min/max/avg/count of int and float columns (missing excluded)."""
    return prof.where(F.col("type").isin("int", "float") & (F.col("stat_count") > 0)).select(
        *keys, "column", "type",
        F.col("stat_min").alias("min"), F.col("stat_max").alias("max"),
        F.col("stat_avg").alias("avg"), F.col("stat_count").alias("count"),
        F.col("n_nan").alias("nan_count"),
    )


def profile_missing(prof: DataFrame, keys: Sequence[str] = ("file_name",)) -> DataFrame:
    """A3: missing count and percentage, only columns with at least one."""
    p = _pct_cols(prof.where(F.col("n_missing") > 0), {"missing_pct": ("n_missing", "n_rows")})
    return p.select(*keys, "column", F.col("n_missing").alias("missing_count"), "missing_pct")


def with_expected(prof: DataFrame, declared: DataFrame | None = None,
                  keys: Sequence[str] = ("file_name",)) -> DataFrame:
    """Attach ``expected_type`` and ``invalid_count`` to every column profile.

    Without ``declared`` the expected type is the inferred one (the reference's
    rule, under which the count is always 0).  ``declared`` = DataFrame(column,
    expected_type[, file keys]) is a per-column table; it is joined at (file,
    column) grain after aggregation, so there is no extra pass over cells.
    """
    if declared is None:
        p = prof.withColumn("expected_type", F.col("type"))
    else:
        on = [c for c in declared.columns if c in (*keys, "column")]
        p = prof.join(declared.select(*on, "expected_type"), on=on, how="left")
    invalid = (
        F.when(F.col("expected_type") == "int", F.col("n_present") - F.col("n_int"))
        .when(F.col("expected_type") == "float", F.col("n_present") - F.col("n_float"))
    )
    return p.withColumn("invalid_count", invalid)


def profile_invalid(prof: DataFrame, declared: DataFrame | None = None,
                    keys: Sequence[str] = ("file_name",)) -> DataFrame:
    """A4: invalid count of int/float-typed columns, only those with any."""
    p = _pct_cols(with_expected(prof, declared, keys).where(F.col("invalid_count") > 0),
                  {"invalid_pct": ("invalid_count", "n_rows")})
    return p.select(*keys, "column", "expected_type", "invalid_count", "invalid_pct")


def file_profile(prof: DataFrame, declared: DataFrame | None = None,
                 keys: Sequence[str] = ("file_name",)) -> DataFrame:
    """One row per file with counts, issue flag and the nested summary.

    ``schema`` / ``statistics`` / ``missing_values`` / ``invalid_values`` are
    maps in header order; each file's entries are bounded by its column count.
    """
    keys = list(keys)
    p = _pct_cols(with_expected(prof, declared, keys),
                  {"missing_pct": ("n_missing", "n_rows"), "invalid_pct": ("invalid_count", "n_rows")})
    has_inv = F.coalesce(F.col("invalid_count") > 0, F.lit(False))
    entry = F.struct(
        F.col("ordinal"), F.col("column"), F.col("type"),
        F.when(F.col("type").isin("int", "float") & (F.col("stat_count") > 0),
               F.struct(F.col("stat_min").alias("min"), F.col("stat_max").alias("max"),
                        F.col("stat_avg").alias("avg"), F.col("stat_count").alias("count"))
               ).alias("stats"),
        F.when(F.col("n_missing") > 0,
               F.struct(F.col("n_missing").alias("count"), F.col("missing_pct").alias("percentage"))
               ).alias("missing"),
        F.when(has_inv,
               F.struct(F.col("invalid_count").alias("count"), F.col("invalid_pct").alias("percentage"),
                        F.col("expected_type").alias("expected_type"))
               ).alias("invalid"),
    )
    per_file = p.groupBy(*keys).agg(
        F.max("n_rows").alias("row_count"),
        F.count(F.lit(1)).alias("column_count"),
        F.array_sort(F.collect_list(entry)).alias("_cols"),
        F.count_if(F.col("type").isin("int", "float") & (F.col("stat_count") > 0)).alias("n_numeric"),
        F.count_if(F.col("n_missing") > 0).alias("n_missing_columns"),
        F.count_if(has_inv).alias("n_invalid_columns"),
    )
    cols = F.col("_cols")
    return per_file.select(
        *keys, "row_count", "column_count", "n_numeric", "n_missing_columns", "n_invalid_columns",
        ((F.col("n_missing_columns") + F.col("n_invalid_columns")) > 0).alias("has_issues"),
        F.map_from_entries(F.transform(cols, lambda e: F.struct(e["column"], e["type"]))).alias("schema"),
        F.map_from_entries(F.transform(F.filter(cols, lambda e: e["stats"].isNotNull()),
                                       lambda e: F.struct(e["column"], e["stats"]))).alias("statistics"),
        F.map_from_entries(F.transform(F.filter(cols, lambda e: e["missing"].isNotNull()),
                                       lambda e: F.struct(e["column"], e["missing"]))).alias("missing_values"),
        F.map_from_entries(F.transform(F.filter(cols, lambda e: e["invalid"].isNotNull()),
                                       lambda e: F.struct(e["column"], e["invalid"]))).alias("invalid_values"),
        F.array_join(F.transform(cols, lambda e: F.concat(e["column"], F.lit(":"), e["type"])), ",")
        .alias("schema_text"),
    )


def summary_document(files: DataFrame, upload_col: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The nested per-file summary document, ready for a JSON sink.

    ``summary_key`` = ``processed/<file name with every ".csv" removed>_summary.json``;
    ``keep`` carries extra columns (e.g. ``file_path``) along.
    """
    upload = F.col(upload_col).cast("string") if upload_col else F.lit(None).cast("string")
    return files.select(
        *keep,
        "file_name",
        summary_key("file_name").alias("summary_key"),
        upload.alias("upload_timestamp"),
        iso_utc(F.current_timestamp()).alias("processed_timestamp"),
        "row_count", "column_count", "schema", "statistics",
        F.struct(F.col("row_count").alias("total_rows"), "missing_values", "invalid_values",
                 "has_issues").alias("quality_issues"),
    )


# ---------------------------------------------------------------------------
# Typed tables: use the schema instead of re-parsing text
# ---------------------------------------------------------------------------

def typed_kind(dtype) -> str | None:
    """The inferred type a typed column always gets under the text rules
    (int / float / date), or None when its values must be inferred as text."""
    from pyspark.sql import types as T
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int"
    if isinstance(dtype, T.DecimalType):
        return "int" if dtype.scale == 0 else "float"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "float"
    if isinstance(dtype, T.DateType):
        return "date"
    return None


def _typed_rows(df: DataFrame, name: str, typed) -> DataFrame:
    """One plain aggregation over the typed columns of one table -> one
    profile row per column (built as one SQL statement over ``df``)."""
    def q(x: str) -> str:
        return "`" + x.replace("`", "``") + "`"

    def lit(x: str) -> str:
        return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"

    aggs = ["count(1) AS _n"]
    rows = []
    for i, f, kind in typed:
        c = q(f.name)
        aggs.append(f"count({c}) AS _p{i}")
        numeric = kind in ("int", "float")
        if numeric:
            v = f"CAST({c} AS DECIMAL(38,0))" if kind == "int" else f"CASE WHEN NOT isnan({c}) THEN {c} END"
            total = f"CAST(try_sum({v}) AS DOUBLE)" if kind == "int" else f"sum({v})"
            nan = f"count_if(isnan({c}))" if kind == "float" else "CAST(0 AS BIGINT)"
            aggs += [f"CAST(min({v}) AS DOUBLE) AS _min{i}", f"CAST(max({v}) AS DOUBLE) AS _max{i}",
                     f"{total} AS _sum{i}", f"{nan} AS _nan{i}"]
            stats = [f"IF(_p{i} > 0, _min{i}, NULL)", f"IF(_p{i} > 0, _max{i}, NULL)",
                     f"IF(_p{i} - _nan{i} > 0, _sum{i} / (_p{i} - _nan{i}), NULL)", f"IF(_p{i} > 0, _p{i}, NULL)",
                     f"_nan{i}"]
        else:
            stats = ["CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS BIGINT)",
                     "0L"]
        fields = dict(zip(["stat_min", "stat_max", "stat_avg", "stat_count", "nan_count"], stats))
        rows.append(f"named_struct('ordinal', {i}, 'column', {lit(f.name)}, 'n_rows', _n, 'n_missing', _n - _p{i}, "
                    f"'n_present', _p{i}, 'type', IF(_p{i} > 0, '{kind}', 'string'), "
                    + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")")
    sql = (f"SELECT {lit(name)} AS file_name, r.* FROM (SELECT explode(array({', '.join(rows)})) AS r "
           f"FROM (SELECT {', '.join(aggs)} FROM {{df}}))")
    return df.sparkSession.sql(sql, df=df)


def profile_tables(tables: dict[str, DataFrame], row_no: F.Column | None = None) -> DataFrame:
    """Column profiles of typed DataFrames (one "file" per name).

    Integer, decimal, floating and date columns take their type from the
    schema and their statistics from one plain aggregation per table over the
    typed values (no unpivot, no regex); NULL counts as missing and NaN is kept
    out of min/max/avg as in the text path.  All other columns are rendered as
    text and inferred together through one cells profile, arrays and other nested
    values as their text form.  Rows are ordered by ``row_no``; by default by path
    and position for tables read from files, else as scanned.

    Output: file_name, ordinal, column, n_rows, n_missing, n_present, type,
    stat_min, stat_max, stat_avg, stat_count, nan_count.
    """
    from tessera.operators.cells import ordered_rows, to_cells
    parts, cell_parts = [], []
    for name, df in tables.items():
        fields = list(enumerate(df.schema.fields, 1))
        typed = [(i, f, typed_kind(f.dataType)) for i, f in fields if typed_kind(f.dataType)]
        text = [(i, f) for i, f in fields if not typed_kind(f.dataType)]
        if typed:
            parts.append(_typed_rows(df, name, typed))
        if text:
            if row_no is not None:
                rows = df.withColumn("_row", row_no)
            elif df.inputFiles():
                rows = ordered_rows(df, "_row")
            else:
                rows = df.withColumn("_row", F.monotonically_increasing_id())
            wide = rows.select(F.lit(name).alias("file_name"), F.col("_row").alias("row_no"),
                               *[F.col(f"`{f.name}`").cast("string").alias(f.name) for _, f in text])
            cells = to_cells(wide, ("file_name", "row_no"), [f.name for _, f in text])
            pos = F.create_map(*[x for i, f in text for x in (F.lit(f.name), F.lit(i))])
            cell_parts.append(cells.withColumn("ordinal", pos[F.col("column")]))
    if cell_parts:
        cells = cell_parts[0]
        for c in cell_parts[1:]:
            cells = cells.unionByName(c)
        prof = column_profile(cells)
        parts.append(prof.select("file_name", "ordinal", "column", "n_rows", "n_missing", "n_present", "type",
                                 "stat_min", "stat_max", "stat_avg", "stat_count", F.col("n_nan").alias("nan_count")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def profile_table(df: DataFrame, name: str, row_no: F.Column | None = None) -> DataFrame:
    """Column profile of one typed DataFrame (see ``profile_tables``)."""
    return profile_tables({name: df}, row_no)
