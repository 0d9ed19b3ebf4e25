"""Streaming queries (T9-T11 as a stream). The stream must produce exactly
the batch result, so the batch SQL is their oracle."""

from __future__ import annotations

import math
import uuid
from datetime import datetime

from pyspark.sql import functions as F

from trustframe.functions.exprs import rate
from trustframe.operators import drift as dr
from trustframe.operators import monitor as mo
from trustframe.plans import drift_q
from trustframe.plans.monitor_q import CONSEC_SQL, HOURLY_SQL, LABEL, PRED, PRIV, _WCOLS
from trustframe.plans.registry import T, register, rnd
from trustframe.session import ensure_checkpoint_dir
from trustframe.sources import sinks as sk
from trustframe.streaming import (drift_alerts_by_window, event_stream, final_counts, final_histograms, latest_windows,
                                  run_batch_function, run_hourly_monitor, to_files, violation_runs, windows_stream)


@register("stream_monitor", rnd(HOURLY_SQL, _WCOLS))
def stream_monitor(spark, sf):
    """T9 streamed: events file source, 2 h watermark, hourly windows,
    idempotent foreachBatch sink; returns the final window table."""
    ev = event_stream(spark, sf, "events.parquet")
    sink = run_hourly_monitor(spark, ev, LABEL(), PRED(), PRIV())
    return latest_windows(spark, sink)


@register("stream_consecutive_violations", CONSEC_SQL)
def stream_consecutive_violations(spark, sf):
    """T11 on the streamed window table: 3 consecutive failed checks."""
    w = stream_monitor(spark, sf)
    return mo.consecutive_runs(w, "window_start", ~F.col("fairness_pass"), 3)


_REF = f"""(SELECT value, CAST(user_id AS DOUBLE) AS user_id, event_type FROM events
  WHERE ts < TIMESTAMP '{drift_q.CUT}')"""
_ALL = "(SELECT value, CAST(user_id AS DOUBLE) AS user_id, event_type FROM events)"


@register("stream_drift_alerts", rnd(f"""
SELECT 'data_drift' AS drift_type, feature AS metric, score AS current_value,
  0.1::DOUBLE AS threshold, 'medium' AS severity, drifted
FROM ({drift_q.features_sql(["value", "user_id"], ["event_type"], _REF, _ALL)}) f""",
    ["current_value", "threshold"]))
def stream_drift_alerts(spark, sf):
    """T1 + T2 streamed: the batch drift function applied to every micro-batch
    of the events stream against the reference half (foreachBatch)."""
    ref = T(spark, sf, "events").where(F.col("ts") < F.lit(drift_q.CUT).cast("timestamp")) \
        .select("value", F.col("user_id").cast("double").alias("user_id"), "event_type")
    # read once and stored; no reference rows are read in a batch
    path = f"{ensure_checkpoint_dir(spark)}/profile-{uuid.uuid4().hex}"
    dr.reference_profile(ref, ["value", "user_id"], ["event_type"]).write.parquet(path)
    profile = spark.read.parquet(path)

    def per_batch(batch):
        cur = batch.select("value", F.col("user_id").cast("double").alias("user_id"), "event_type")
        feats = dr.drift_from_profile(profile, cur)
        return feats.select(F.lit("data_drift").alias("drift_type"),
                            F.col("feature").alias("metric"),
                            F.col("score").alias("current_value"),
                            F.lit(dr.DATA_DRIFT).alias("threshold"),
                            F.lit("medium").alias("severity"), "drifted")
    sink = run_batch_function(spark, event_stream(spark, sf, "events.parquet"), per_batch)
    return spark.read.parquet(sink).drop("batch")


#: Events in a file of an arriving source
FILE_ROWS = 500_000


def slice_files(spark, sf, n: int) -> int:
    """Files that each of ``n`` slices of the events is written as, so that no task writes much over ``FILE_ROWS`` rows."""
    return max(1, math.ceil(T(spark, sf, "events").count() / n / FILE_ROWS))


def state_parts(spark) -> int:
    """Parts of a small state: as many as tasks run at once, and no more than the session's shuffle partitions."""
    return min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def events_in_files(spark, sf, n: int, files: int = 1) -> str:
    """The events as ``n`` slices in order of time, each of ``files`` files that are newer than those before: a source that
    arrives. A slice of few rows is filled up with empty files, so ``files`` a micro-batch are one slice."""
    path = f"{ensure_checkpoint_dir(spark)}/arriving-{uuid.uuid4().hex}"
    ev = T(spark, sf, "events")
    cuts = ev.select(F.percentile_approx(F.col("ts").cast("timestamp"), F.array(*[F.lit((i + 1) / n) for i in range(n - 1)]), 10000).alias("c")).first()["c"]
    edges, done = [None, *cuts, None], 0
    for lo, hi in zip(edges[:-1], edges[1:]):
        part = ev.withColumn("ts", F.col("ts").cast("timestamp"))
        part = part if lo is None else part.where(F.col("ts") > F.lit(lo))
        part = part if hi is None else part.where(F.col("ts") <= F.lit(hi))
        part.repartition(files).write.mode("append").parquet(path)
        done += files
        for _ in range(done - len(spark.read.parquet(path).inputFiles()) if files > 1 else 0):
            part.limit(0).coalesce(1).write.mode("append").parquet(path)
    return path


def type_windows(spark, source: str, base: str, files: int | None = None) -> str:
    """Final hourly windows of each event type, as a table."""
    ev = event_stream(spark, source, "*.parquet", files)
    return to_files(final_counts(ev, LABEL(), PRED(), PRIV(), {"event_type": F.col("event_type")}), base, ["event_type"], "windows",
                    partitions=state_parts(spark))


def type_fails():
    """A window fails where the group's rates of positive predictions differ by over 0.1."""
    return F.abs(rate(F.col("pos_unpriv"), F.col("n_unpriv")) - rate(F.col("pos_priv"), F.col("n_priv"))) > 0.1


_TYPE_RUNS_SQL = """
WITH w AS (SELECT event_type, date_trunc('hour', ts) AS window_start,
    abs(CASE WHEN count_if(user_id % 2 <> 0) > 0 THEN count_if(user_id % 2 <> 0 AND value > 30.0) / count_if(user_id % 2 <> 0) ELSE 0 END
      - CASE WHEN count_if(user_id % 2 = 0) > 0 THEN count_if(user_id % 2 = 0 AND value > 30.0) / count_if(user_id % 2 = 0) ELSE 0 END) > 0.1 AS fail
  FROM events GROUP BY 1, 2
  HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 HOUR FROM events)),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY window_start)
        - row_number() OVER (PARTITION BY event_type, fail ORDER BY window_start) AS island FROM w)
SELECT event_type, window_start, 3::INT AS run_length
FROM (SELECT *, row_number() OVER (PARTITION BY event_type, island ORDER BY window_start) AS n FROM r WHERE fail) WHERE n = 3"""


@register("stream_violation_runs", _TYPE_RUNS_SQL)
def stream_violation_runs(spark, sf):
    """T11 + T14 as a stateful stream: seven slices, one a micro-batch, into final windows per event
    type; a second stream keeps each type's run and reports where it reaches three."""
    base, files = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}", slice_files(spark, sf, 7)
    sink = type_windows(spark, events_in_files(spark, sf, 7, files), base, files)
    runs = to_files(violation_runs(windows_stream(spark, sink, 2), type_fails(), ["event_type"]), base, name="runs", idle_batches=False,
                    partitions=state_parts(spark))
    schema = "event_type string, window_start timestamp, run_length int"
    return spark.read.schema(schema).parquet(runs).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _windowed_sql():
    days = "(SELECT date_trunc('day', ts) AS day FROM events GROUP BY 1 HAVING day + INTERVAL 1 DAY <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 HOUR FROM events))"
    ref = f"(SELECT r.*, d.day::VARCHAR AS day FROM {_REF} r, {days} d)"
    cur = f"(SELECT value, CAST(user_id AS DOUBLE) AS user_id, event_type, d.day::VARCHAR AS day FROM events JOIN {days} d ON date_trunc('day', ts) = d.day)"
    sql = drift_q.features_sql(["value", "user_id"], ["event_type"], ref, cur)
    for c in ("value", "user_id", "event_type"):
        sql = sql.replace(f"SELECT '{c}' AS feature", f"SELECT day || '|{c}' AS feature").replace(f"SELECT '{c}',", f"SELECT day || '|{c}',")
    return f"""
SELECT split_part(feature, '|', 1)::TIMESTAMP AS window_start, 'data_drift' AS drift_type, split_part(feature, '|', 2) AS metric,
  score AS current_value, 0.1::DOUBLE AS threshold, 'medium' AS severity, drifted FROM ({sql}) f"""


@register("stream_windowed_drift", rnd(_windowed_sql(), ["current_value", "threshold"]))
def stream_windowed_drift(spark, sf):
    """T1 + T2 by event time: counts per day, feature and value as stream state, each final day against the
    stored profile of the reference half."""
    ref = T(spark, sf, "events").where(F.col("ts") < F.lit(drift_q.CUT).cast("timestamp")) \
        .select("value", F.col("user_id").cast("double").alias("user_id"), "event_type")
    base = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    dr.reference_profile(ref, ["value", "user_id"], ["event_type"]).write.parquet(f"{base}/profile")
    files = slice_files(spark, sf, 7)
    sink = to_files(final_histograms(event_stream(spark, events_in_files(spark, sf, 7, files), "*.parquet", files), ["value", "user_id"], ["event_type"]), base, name="days")
    out = drift_alerts_by_window(spark.read.parquet(f"{base}/profile"), spark.read.parquet(sink))
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@register("history_retention", """
SELECT strftime(ts, '%Y-%m-%d') AS date, count(*)::BIGINT AS n FROM events
WHERE CAST(ts AS DATE) + INTERVAL 1 DAY > TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 168 HOUR GROUP BY 1""")
def history_retention(spark, sf):
    """A history by day after whole days older than 168 hours were dropped."""
    path = f"{ensure_checkpoint_dir(spark)}/history-{uuid.uuid4().hex}"
    sk.append_history(T(spark, sf, "events").select("event_id", "ts"), path)
    sk.expire_history(spark, path, datetime(2024, 1, 20, 12), mo.RETENTION_HOURS)
    return spark.read.parquet(path).groupBy(F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("n"))
