"""Run a registered query in Spark and its SQL twin in DuckDB; compare."""

from __future__ import annotations

import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _canon(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return (round(v, 2) if abs(v) >= 1e4 else round(v, 6)) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def compare(spark, name: str, sf_dir: str, fn, sql: str, show: int = 3) -> dict:
    sdf = fn(spark, sf_dir)
    scols = sorted(sdf.columns)
    srows = sorted((tuple(_canon(r[c]) for c in scols) for r in sdf.collect()), key=repr)
    con = duck(sf_dir)
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows_raw = res.fetchall()
    idx = [dcols.index(c) for c in scols] if sorted(dcols) == scols else None
    out = {"name": name, "spark_rows": len(srows), "duck_rows": len(drows_raw),
           "cols_match": sorted(dcols) == scols}
    if idx is None:
        out["spark_cols"], out["duck_cols"] = scols, sorted(dcols)
        out["match"] = False
        return out
    drows = sorted((tuple(_canon(r[i]) for i in idx) for r in drows_raw), key=repr)
    diffs = [(a, b) for a, b in zip(srows, drows) if a != b]
    out["mismatch"] = len(diffs) + abs(len(srows) - len(drows))
    out["match"] = out["mismatch"] == 0
    out["examples"] = diffs[:show]
    out["cols"] = scols
    return out
