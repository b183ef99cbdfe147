"""Side-by-side check of a Spark query against its DuckDB oracle SQL.

Mirrors the driver's gate: row count, column names, and an order-insensitive
comparison of values (floats rounded) on the same Parquet tables.
"""

from __future__ import annotations

import datetime as _dt
import math
import os

import duckdb

from larder.sources.tables import DRIVER_TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        r = round(v, digits)
        return 0.0 if r == 0 else r
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "tolist"):
        return _norm(v.tolist(), digits)
    return v


def rows_of(columns, rows, digits):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark_df, sql: str, con, digits: int = 6, show: int = 5):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    report = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
              "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not report["columns_match"]:
        report["spark_cols"] = sorted(s_cols)
        report["oracle_cols"] = sorted(d_cols)
        report["ok"] = False
        return report
    a, b = rows_of(s_cols, s_rows, digits), rows_of(d_cols, d_rows, digits)
    report["values_match"] = a == b
    if a != b:
        sa, sb = set(a), set(b)
        report["only_spark"] = [r for r in a if r not in sb][:show]
        report["only_oracle"] = [r for r in b if r not in sa][:show]
        report["cols"] = sorted(s_cols)
    report["ok"] = report["columns_match"] and report["values_match"]
    return report
