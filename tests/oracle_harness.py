"""Side-by-side check of a registered Spark query against its DuckDB oracle,
in the way the correctness gate compares them: same column names, same row
count, same multiset of rows (order-insensitive)."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits: int):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (int, float)):
        f = float(v)
        if math.isnan(f):
            return None
        return float(f"{f:.{digits}g}")
    return v


def _rows(pdf: pd.DataFrame, digits: int) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v, digits) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame, digits: int = 12) -> dict:
    res = {
        "spark_rows": len(spark_pdf), "oracle_rows": len(duck_pdf),
        "columns_match": sorted(spark_pdf.columns) == sorted(duck_pdf.columns),
        "spark_columns": sorted(spark_pdf.columns), "oracle_columns": sorted(duck_pdf.columns),
    }
    if res["columns_match"] and len(spark_pdf) == len(duck_pdf):
        a, b = _rows(spark_pdf, digits), _rows(duck_pdf, digits)
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        res["values_match"] = not diff
        res["first_diff"] = diff[:3]
    else:
        res["values_match"] = False
    return res


def check(spark, name: str, sf_dir: str, digits: int = 12) -> dict:
    import __spark_entry__ as E
    sdf = E.queries()[name](spark, sf_dir)
    s = sdf.toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        return {"spark_rows": len(s), "oracle": None}
    d = duck(sf_dir).execute(sql).df()
    return compare(s, d, digits)
