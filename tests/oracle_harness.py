"""Spark result vs DuckDB oracle: row count, column names/kinds and order-insensitive values."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

from martlens.sources.tables import BASE_TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _kind(type_name: str) -> str:
    t = type_name.lower()
    if any(x in t for x in ("int", "long", "short", "byte")):
        return "int"
    if any(x in t for x in ("double", "float", "decimal")):
        return "float"
    if any(x in t for x in ("string", "varchar", "char")):
        return "str"
    if "timestamp" in t:
        return "ts"
    if "date" in t:
        return "date"
    return t


def _sort_key(row):
    return tuple((0, "") if v is None else (1, str(type(v)), v) for v in row)


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> dict:
    """Return a dict with ok flags and a short diff description."""
    s_cols = spark_df.columns
    s_types = {f.name: _kind(f.dataType.simpleString()) for f in spark_df.schema.fields}
    s_rows = [tuple(_norm(r[c]) for c in sorted(s_cols)) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_types = {d[0]: _kind(str(d[1])) for d in rel.description}
    d_raw = rel.fetchall()
    idx = {c: i for i, c in enumerate(d_cols)}
    d_rows = [tuple(_norm(r[idx[c]]) for c in sorted(d_cols)) for r in d_raw]
    out = {
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
        "schema_ok": sorted(s_cols) == sorted(d_cols)
        and all(s_types[c] == d_types.get(c) for c in s_cols),
        "schema": (sorted(s_types.items()), sorted(d_types.items())),
    }
    out["rows_ok"] = out["rows_spark"] == out["rows_oracle"]
    s_sorted = sorted(s_rows, key=_sort_key)
    d_sorted = sorted(d_rows, key=_sort_key)
    out["values_ok"] = s_sorted == d_sorted
    if not out["values_ok"]:
        s_set, d_set = set(s_sorted), set(d_sorted)
        out["only_spark"] = sorted(s_set - d_set, key=_sort_key)[:5]
        out["only_oracle"] = sorted(d_set - s_set, key=_sort_key)[:5]
    out["ok"] = out["rows_ok"] and out["schema_ok"] and out["values_ok"]
    return out
