"""Run a registered Spark query and its DuckDB oracle on the same parquet
tables and compare row count, column names and order-insensitive values."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v + 0.0 if os.environ.get("EXACT") else round(v, 6) + 0.0
    if hasattr(v, "isoformat") and not isinstance(v, str):
        # dates and midnight timestamps normalise alike (DuckDB hands DATE to
        # pandas as datetime64)
        t = pd.Timestamp(v)
        if pd.isna(t):
            return None
        return t.date().isoformat() if t == t.normalize() else t.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    out.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return out


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as e
    oracles = e.oracle_sql()
    t0 = time.time()
    sdf = e.queries()[name](spark, sf_dir).toPandas()
    t1 = time.time()
    res = {"query": name, "spark_rows": len(sdf), "spark_sec": round(t1 - t0, 2)}
    if name not in oracles:
        res["status"] = "no-oracle"
        return res
    con = con or duck(sf_dir)
    odf = con.execute(oracles[name]).df()
    res["oracle_rows"] = len(odf)
    if sorted(sdf.columns) != sorted(odf.columns):
        res["status"] = f"columns differ: {sorted(sdf.columns)} vs {sorted(odf.columns)}"
        return res
    a, b = rows_of(sdf), rows_of(odf)
    if len(a) != len(b):
        res["status"] = "row count differs"
        return res
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    res["status"] = "ok" if not bad else f"{len(bad)} rows differ, e.g. {bad[:2]}"
    return res


if __name__ == "__main__":
    from tickwave.session import build_session
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session()
    import __spark_entry__ as e
    names = sys.argv[1:] or sorted(e.queries())
    con = duck(sf)
    for n in names:
        try:
            print(compare(spark, n, sf, con), flush=True)
        except Exception as e:  # report and continue
            print({"query": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}, flush=True)
