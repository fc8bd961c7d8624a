"""Run a registered query in Spark and its oracle SQL in DuckDB; compare
row count, column names and the order-insensitive multiset of values."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from tessera.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return repr(v) if not isinstance(v, (int, str, bool)) else v


# Spark type name -> DuckDB type name of the same values.
TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
            "float": "FLOAT", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def compare(spark, con, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = dict(sdf.dtypes)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = {"rows_spark": len(s_rows)}
    if sql is None:
        res["match"] = None
        return res
    d = con.execute(sql)
    d_cols = [c[0] for c in d.description]
    d_rows = d.fetchall()
    res["rows_oracle"] = len(d_rows)
    res["cols_match"] = sorted(s_cols) == sorted(d_cols)
    d_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    res["types_match"] = all(TYPE_MAP.get(t, t) == d_types.get(c) for c, t in s_types.items())
    if not res["cols_match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
        res["match"] = False
        return res
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    cs = Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
    cd = Counter(tuple(_norm(r[i]) for i in di) for r in d_rows)
    res["match"] = cs == cd
    if not res["match"]:
        res["only_spark"] = list((cs - cd).elements())[:3]
        res["only_oracle"] = list((cd - cs).elements())[:3]
        res["columns"] = order
    return res
