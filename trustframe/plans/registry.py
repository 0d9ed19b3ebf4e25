"""Query registry shared by the plan modules.

``register(name, sql=None)`` records a callable ``(spark, sf_dir) -> DataFrame``
and, when the result is expressible in SQL, the DuckDB oracle text.
Double columns are rounded in both (``rnd``) because summation order differs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from trustframe.functions.exprs import round_doubles
from trustframe.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DIGITS = 6
#: doubles are rounded for the comparison with SQL; bench.py turns it off
ROUND = True


def register(name: str, sql: str | None = None, rounded: bool = True):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the tables carry zone-less timestamps; every query reads them in UTC
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            df = fn(spark, sf_dir)
            return round_doubles(df, DIGITS) if rounded and ROUND else df
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rnd(sql: str, cols: Sequence[str]) -> str:
    """Wrap SQL so the listed double columns are rounded like ``round_doubles``."""
    if not cols:
        return sql
    rep = ", ".join(f"round(CAST({c} AS DOUBLE), {DIGITS}) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"


def T(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)
