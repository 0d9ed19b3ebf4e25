"""Structured Streaming monitor (T9-T12 as a stream).

events file source -> watermark -> hourly window aggregate (the same
conditional counts as the batch ``window_metrics``) -> ``foreachBatch`` sink.
Each micro-batch's updated windows are written under ``batch=<id>`` with
overwrite of that partition only, so a retried batch replaces its own output
(idempotent); readers keep the newest version of every window. Late rows
older than the watermark are dropped by Spark and never reach a window that
was already final.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trustframe.operators.monitor import counted_metrics, window_counts
from trustframe.session import ensure_checkpoint_dir

EVENTS_SCHEMA = ("event_id bigint, ts timestamp, user_id bigint, event_type string, value double, "
                 "props string")


def event_stream(spark: SparkSession, directory: str, glob: str = "*.parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory)


def hourly_window_stream(events: DataFrame, label: Column, pred: Column, priv: Column,
                         watermark: str = "2 hours", duration: str = "1 hour") -> DataFrame:
    """Watermarked event-time window counts; metrics are derived from the
    counts when read (they are not additive, the counts are)."""
    return window_counts(events.withWatermark("ts", watermark), "ts", label, pred, priv, duration)


def run_hourly_monitor(spark: SparkSession, events: DataFrame, label: Column, pred: Column,
                       priv: Column, out_dir: str | None = None, watermark: str = "2 hours",
                       timeout_s: int | None = None) -> str:
    """Run the stream to completion (``availableNow``) and return the sink
    folder. Checkpoint and sink live in the shared checkpoint folder."""
    base = out_dir or f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    sink, ckpt = f"{base}/windows", f"{base}/_checkpoint"
    agg = hourly_window_stream(events, label, pred, priv, watermark)

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "*").drop("w")
         .withColumn("batch", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(sink))

    q = (agg.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()  # no limit unless asked for
    if q.isActive:
        q.stop()
        raise TimeoutError("stream did not finish")
    if q.exception():
        raise q.exception()
    return sink


def latest_windows(spark: SparkSession, sink: str) -> DataFrame:
    """Newest version of every window, with the batch metrics derived from
    the counts (same columns and types as ``monitor.window_metrics`` on the
    zone-less event time of the tables)."""
    raw = spark.read.parquet(sink)
    w = Window.partitionBy("window_start").orderBy(F.col("batch").desc())
    last = raw.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r", "batch")
    return counted_metrics(last.withColumn("w", F.struct(
        F.col("window_start").cast("timestamp_ntz").alias("start"), F.col("window_end").cast("timestamp_ntz").alias("end"))))


def run_batch_function(spark: SparkSession, stream: DataFrame, fn, out_dir: str | None = None,
                       timeout_s: int | None = None) -> str:
    """T1 as a stream: apply the batch function ``fn(batch_df) -> DataFrame``
    to every micro-batch (``foreachBatch``) and append its rows under
    ``batch=<id>`` (overwrite of that partition only, so a retried batch
    replaces its own output). Returns the sink folder."""
    base = out_dir or f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    sink, ckpt = f"{base}/out", f"{base}/_checkpoint"

    def write(batch: DataFrame, batch_id: int) -> None:
        (fn(batch).withColumn("batch", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(sink))

    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()  # no limit unless asked for
    if q.isActive:
        q.stop()
        raise TimeoutError("stream did not finish")
    if q.exception():
        raise q.exception()
    return sink
