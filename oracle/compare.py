"""Spark result vs DuckDB SQL: row count, column names, order-insensitive values."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

RAW_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in RAW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, sql: str, con) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    out = {"spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    if not out["cols_match"]:
        out["only_spark"] = sorted(set(s_cols) - set(d_cols))
        out["only_duck"] = sorted(set(d_cols) - set(s_cols))
        out["ok"] = False
        return out
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    out["ok"] = a == b
    if not out["ok"]:
        out["spark_only_sample"] = list((a - b).elements())[:3]
        out["duck_only_sample"] = list((b - a).elements())[:3]
        out["cols"] = sorted(s_cols)
    return out
