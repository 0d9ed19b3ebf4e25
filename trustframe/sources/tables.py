"""Parquet test tables (one file per table under an ``sf`` folder)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def deal_small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """The rows of a table of few files dealt to all cores, at most about ``rows`` of them to a task: a file would be one
    task, however dear a row is. Tables of more files than cores, none of which holds more than that on average,
    stay as they are read, without a shuffle."""
    cores, files, n = df.sparkSession.sparkContext.defaultParallelism, len(df.inputFiles()), df.count()
    if files >= max(cores, n / rows):
        return df
    return df.repartition(max(cores, -(-n // rows)))
