"""Streams whose state is kept by Spark: final windows, runs of violations per series (T11) with
retention (T14), and drift per event-time window against a stored profile (T1, T2).

A first query counts by event time and writes each window once, when the watermark has passed
it (append mode, file sink). What follows reads that table, which has a row per window
and series (or value), not per event: a second stream with a small state per series, or a batch. Both are
the same however the events' files fall into micro-batches, and go on from their checkpoints.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from trustframe.operators.drift import DATA_DRIFT, tagged_values, windowed_drift
from trustframe.operators.monitor import CONSECUTIVE, RETENTION_HOURS, count_aggregates
from trustframe.session import importable_in_tasks

_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_IDLE = "spark.sql.streaming.noDataMicroBatches.enabled"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_PARTS = "spark.sql.shuffle.partitions"


def to_files(stream: DataFrame, base: str, by: Sequence[str] = (), name: str = "out", idle_batches: bool = True,
             partitions: int | None = None) -> str:
    """Run the stream to its end (``availableNow``) into a Parquet file sink under ``base``, each row exactly
    once; called again with the same ``base`` it goes on from the checkpoint. ``by``: rows of a micro-batch that
    agree in these columns share a file, so a reader takes them together. ``idle_batches``: whether batches without new
    rows run, which emit windows that have become final; a query with state that expires by the clock would always want one
    more and never end. ``partitions``: parts of the state (default: the session's shuffle partitions). Each part opens, commits
    and keeps its own store in every micro-batch, rows or none, so a small state wants few; a checkpoint keeps the number it began
    with. Returns the sink's folder."""
    sink = f"{base}/{name}"
    conf = stream.sparkSession.conf
    if by:
        stream = stream.repartition(*by)
    before = {_IDLE: conf.get(_IDLE, "true"), _PARTS: conf.get(_PARTS)}
    conf.set(_IDLE, str(idle_batches).lower())  # both are read when the query starts
    conf.set(_PARTS, str(partitions or before[_PARTS]))
    try:
        q = (stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", f"{base}/_{name}")
             .outputMode("append").trigger(availableNow=True).start())
    finally:
        for k, v in before.items():
            conf.set(k, v)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return sink


def final_counts(events: DataFrame, label: Column, pred: Column, priv: Column, series: dict[str, Column] | None = None,
                 watermark: str = "2 hours", duration: str = "1 hour") -> DataFrame:
    """The counts of each (window, series) as a stream that holds a window once it is final:
    window_start, window_end, the series' columns and the monitor's COUNTS."""
    series = series or {}
    c = events.withWatermark("ts", watermark).groupBy(F.window("ts", duration).alias("w"), *[v.alias(k) for k, v in series.items()]).agg(
        *count_aggregates(label.cast("int"), pred.cast("int"), priv.cast("boolean")))
    return c.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *[x for x in c.columns if x != "w"])


class _Runs(StatefulProcessor):
    """Per series: start and end of its last window (microseconds) and the failures in a row up to it."""

    def __init__(self, series: list[str], k: int, retention_us: int, ttl_ms: int):
        self.series, self.k, self.retention_us, self.ttl_ms = series, k, retention_us, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", "last_start bigint, last_end bigint, failed bigint", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        frame = pd.concat(list(rows)).sort_values("start_us")
        before = self.run.get() if self.run.exists() else None
        last, end, failed = before if before else (None, None, 0)
        hits = []
        for s, e, bad in zip(frame["start_us"].tolist(), frame["end_us"].tolist(), frame["fail"].tolist()):
            if last is not None and s <= last:
                continue  # seen before
            if end is not None and s - end > self.retention_us:
                failed = 0  # what is older than the retention is forgotten
            last, end, failed = s, e, failed + 1 if bad else 0
            if failed == self.k:
                hits.append((s, failed))
        self.run.update((last, end, failed))
        if hits:
            out = pd.DataFrame(hits, columns=["start_us", "run_length"])
            for name, value in zip(self.series, key):
                out[name] = value
            yield out[[*self.series, "start_us", "run_length"]]

    def close(self) -> None:
        pass


def windows_stream(spark: SparkSession, sink: str, files: int | None = None) -> DataFrame:
    """The table of a ``to_files`` sink as a stream, ``files`` of it a micro-batch."""
    schema = spark.read.parquet(sink).schema
    r = spark.readStream.schema(schema)
    if files:
        r = r.option("maxFilesPerTrigger", files)
    return r.parquet(sink)


def violation_runs(windows: DataFrame, fail: Column, series: Sequence[str] = (), k: int = CONSECUTIVE,
                   retention_hours: int = RETENTION_HOURS, state_ttl: timedelta | None = None) -> DataFrame:
    """A row (series, window_start, run_length) where a series' failures in a row reach ``k``, from a stream of final
    windows in which the files of a series come in the order of its windows (``to_files(..., by=series)``).

    State: three numbers per series, dropped by the state store when no window of the series came for ``state_ttl`` by
    the clock (by default ``retention_hours``, T14). A gap of over ``retention_hours`` between two windows ends a run, so a
    fast replay forgets what a slow one does. There is no watermark: files of one micro-batch reach far back in event time, and
    none of their windows is late. A window that comes twice counts once; a null verdict is no failure. Needs the RocksDB
    state store (set here)."""
    spark = windows.sparkSession
    importable_in_tasks(spark)
    spark.conf.set(_PROVIDER, _ROCKS)
    series = list(series)
    names = series or ["__all"]
    w = windows if series else windows.withColumn("__all", F.lit(0))
    src = w.select(
        *names, F.unix_micros("window_start").alias("start_us"), F.unix_micros("window_end").alias("end_us"),
        F.coalesce(fail, F.lit(False)).alias("fail"))
    keep = timedelta(hours=retention_hours)
    out = ", ".join(f"`{n}` {src.schema[n].dataType.simpleString()}" for n in names) + ", start_us bigint, run_length bigint"
    runs = src.groupBy(*names).transformWithStateInPandas(
        _Runs(names, k, keep // timedelta(microseconds=1), (state_ttl or keep) // timedelta(milliseconds=1)), out, "Append", "ProcessingTime")
    return runs.select(*series, F.timestamp_micros("start_us").alias("window_start"), F.col("run_length").cast("int").alias("run_length"))


def final_histograms(events: DataFrame, numeric: Sequence[str], categorical: Sequence[str], watermark: str = "2 hours",
                     duration: str = "1 day") -> DataFrame:
    """Counts of each (window, feature, value) as a stream that holds a window once it is final: window_start, feature, kind,
    v_num, v_str, n."""
    tagged = tagged_values(events.withWatermark("ts", watermark), numeric, categorical, keep=["ts"])
    c = tagged.groupBy(F.window("ts", duration).alias("w"), "feature", "kind", "v_num", "v_str").agg(F.count(F.lit(1)).alias("n"))
    return c.select(F.col("w.start").alias("window_start"), "feature", "kind", "v_num", "v_str", "n")


def drift_alerts_by_window(profile: DataFrame, counts: DataFrame, threshold: float = DATA_DRIFT) -> DataFrame:
    """T1 + T2: one row per final window and feature from the table of ``final_histograms``: window_start, drift_type,
    metric, current_value, threshold, severity, drifted."""
    d = windowed_drift(profile, counts, threshold)
    return d.select("window_start", F.lit("data_drift").alias("drift_type"), F.col("feature").alias("metric"), F.col("score").alias("current_value"),
                    F.lit(float(threshold)).alias("threshold"), F.lit("medium").alias("severity"), "drifted")
