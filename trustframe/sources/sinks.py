"""Materialisation and sinks: result cache, split tables, reports, history,
request parsing (S6, S8, S11-S15)."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def cache_key(path: str, params: dict) -> str:
    return hashlib.md5((path + json.dumps(params, sort_keys=True, default=str)).encode()) \
        .hexdigest()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system that Spark reads the path from."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def source_state(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files at ``path``: changes when the source does."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return "none"
    out, it = [], fs.listFiles(p, True)
    while it.hasNext():
        f = it.next()
        out.append(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}")
    return ",".join(sorted(out))


def cached_result(spark: SparkSession, cache_root: str, source_path: str, params: dict,
                  build: Callable[[], DataFrame]) -> DataFrame:
    """Materialise ``build()`` as Parquet under md5(path + params + state of
    the source's files) and reuse it when a complete copy (``_SUCCESS``) exists. Never pickles."""
    state = {"params": params, "source": source_state(spark, source_path)}
    out = f"{cache_root.rstrip('/')}/{cache_key(source_path, state)}"
    if not path_exists(spark, out + "/_SUCCESS"):
        build().write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def save_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """One Parquet table partitioned by split."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def load_splits(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)  # partition pruning


def write_report(rows: DataFrame, path: str) -> None:
    """One JSON line per report row; non-scalar values become JSON text."""
    out = []
    for f in rows.schema.fields:
        t = f.dataType.typeName()
        out.append(F.to_json(F.col(f.name)).alias(f.name) if t in ("struct", "array", "map")
                   else F.col(f.name))
    rows.select(*out).write.mode("overwrite").json(path)


def append_history(df: DataFrame, path: str, ts_col: str = "ts") -> None:
    """Append-only history partitioned by day."""
    df.withColumn("date", F.to_date(F.col(ts_col))).write.mode("append") \
        .partitionBy("date").parquet(path)


def expire_history(spark: SparkSession, path: str, as_of: datetime, hours: int) -> list[str]:
    """Drop the day partitions of a history (``append_history``) that ended ``hours`` or more before ``as_of``, as
    whole folders; rows of the day the limit falls into stay. Returns the days dropped. Safe to repeat;
    a path that isn't there has none."""
    limit = as_of - timedelta(hours=hours)
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for entry in fs.listStatus(root) if fs.exists(root) else []:
        name = entry.getPath().getName()
        if entry.isDirectory() and re.fullmatch(r"date=\d{4}-\d{2}-\d{2}", name):
            day = name[5:]
            if datetime.strptime(day, "%Y-%m-%d") + timedelta(days=1) <= limit and fs.delete(entry.getPath(), True):
                gone.append(day)
    return sorted(gone)


def parse_requests(df: DataFrame, json_col: str, schema: str) -> DataFrame:
    """JSON request rows -> typed columns (explicit schema, no inference)."""
    return df.withColumn("_req", F.from_json(F.col(json_col), schema)).select("*", "_req.*") \
        .drop("_req")

