"""Run a registered query on Spark and its oracle SQL on DuckDB over the
same parquet files; compare as order-insensitive multisets of rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return round(f, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sql, sf_dir):
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    if not out["cols_match"]:
        out["spark_only"] = sorted(set(s_cols) - set(d_cols))
        out["oracle_only"] = sorted(set(d_cols) - set(s_cols))
        out["ok"] = False
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    out["ok"] = a == b
    if not out["ok"]:
        out["spark_extra"] = list((a - b).elements())[:3]
        out["oracle_extra"] = list((b - a).elements())[:3]
        out["cols"] = sorted(s_cols)
    return out
