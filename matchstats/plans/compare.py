"""Local oracle check: run a registered query on Spark and its SQL on
DuckDB over the same parquet tables, compare rows order-insensitively."""

from __future__ import annotations

import datetime as dt
import math
import time

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)):
        try:
            v = v.item()
        except Exception:  # noqa: BLE001
            pass
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return None
        r = round(v, 6)
        if r == int(r) and abs(r) < 2**53:
            return int(r)
        return r
    if isinstance(v, dt.datetime):
        if v.hour == v.minute == v.second == v.microsecond == 0:
            return v.date().isoformat()
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    try:
        import pandas as pd
        if v is pd.NaT or (not isinstance(v, (str, bytes)) and pd.isna(v)):
            return None
    except (TypeError, ValueError):
        pass
    return v


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of(pdf, cols):
    return sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)),
                  key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, name, fn, sql, sf_dir, con=None) -> dict:
    con = con or duck_connection(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    out = {"name": name, "spark_rows": len(spdf), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    dpdf = con.execute(sql).df()
    out["duck_sec"] = round(time.time() - t1, 2)
    out["duck_rows"] = len(dpdf)
    sc, dc = sorted(spdf.columns), sorted(dpdf.columns)
    if sc != dc:
        out["status"] = "SCHEMA"
        out["detail"] = {"spark_only": sorted(set(sc) - set(dc)), "duck_only": sorted(set(dc) - set(sc))}
        return out
    a, b = rows_of(spdf, sc), rows_of(dpdf, sc)
    if a == b:
        out["status"] = "OK"
    else:
        out["status"] = "VALUES"
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        out["detail"] = {"cols": sc, "first_diffs": diff}
    return out
