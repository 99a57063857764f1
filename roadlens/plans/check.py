"""Side-by-side check of a registered query against its DuckDB oracle."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, exact: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if exact else round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, exact) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist(), exact)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, exact)) for k, x in v.items()))
    return v


def _rows(pdf: pd.DataFrame, exact: bool) -> Counter:
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object).where(pdf[cols].notna(), None)
    return Counter(tuple(_norm(v, exact) for v in row) for row in pdf.itertuples(index=False, name=None))


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from roadlens.plans.catalog import load_all

    fn, sql = load_all()[name]
    sdf = fn(spark, sf_dir).toPandas()
    out = {"name": name, "spark_rows": len(sdf), "spark_cols": sorted(sdf.columns)}
    if sql is None:
        out["oracle"] = None
        return out
    con = con or duck_connect(sf_dir)
    odf = con.sql(sql).df()
    out.update(oracle_rows=len(odf), oracle_cols=sorted(odf.columns))
    out["cols_match"] = out["spark_cols"] == out["oracle_cols"]
    if out["cols_match"]:
        a, b = _rows(sdf, True), _rows(odf, True)
        out["exact"] = a == b
        if not out["exact"]:
            a2, b2 = _rows(sdf, False), _rows(odf, False)
            out["approx"] = a2 == b2
            diff = list((a2 - b2).elements())[:3], list((b2 - a2).elements())[:3]
            out["diff_sample"] = diff
    return out
