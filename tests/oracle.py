"""Spark query vs DuckDB oracle comparison (row count, column names,
order-insensitive values, compared exactly: both sides round doubles with the
same IEEE rule, see functions.exprs.round_half_away)."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None) if v.tzinfo else v
    if isinstance(v, (list, tuple)) or hasattr(v, "tolist"):
        return tuple(_norm(x) for x in (v.tolist() if hasattr(v, "tolist") else v))
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(pdf: pd.DataFrame, cols):
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)  # noqa
    try:
        return sorted(out, key=key)
    except TypeError:
        return sorted(out, key=repr)


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> str | None:
    sc, dc = sorted(spark_pdf.columns), sorted(duck_pdf.columns)
    if sc != dc:
        return f"columns differ: spark={sc} duck={dc}"
    if len(spark_pdf) != len(duck_pdf):
        return f"rows differ: spark={len(spark_pdf)} duck={len(duck_pdf)}"
    a, b = _rows(spark_pdf, sc), _rows(duck_pdf, sc)
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            for c, u, v in zip(sc, x, y):
                if u != v:
                    return f"row {i} col {c}: spark={u!r} duck={v!r}"
    return None
