"""Compare a registered Spark query with its DuckDB oracle.

Mirrors the driver's check: row count, column names, and an
order-insensitive hash of the values (columns sorted by name).
"""
from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return f"{v:.6f}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def fingerprint(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [columns[i] for i in order], lines, h


def compare(spark, con, name, fn, sql, sf_dir):
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sc, sl, sh = fingerprint(s_cols, s_rows)
    dc, dl, dh = fingerprint(d_cols, d_rows)
    ok = sc == dc and len(sl) == len(dl) and sh == dh
    info = {"name": name, "ok": ok, "spark_rows": len(sl), "oracle_rows": len(dl)}
    if sc != dc:
        info["cols"] = (sc, dc)
    elif not ok:
        diff_s = sorted(set(sl) - set(dl))[:3]
        diff_d = sorted(set(dl) - set(sl))[:3]
        info["diff"] = (sc, diff_s, diff_d)
    return info
