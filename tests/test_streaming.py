"""Stream = batch, and late rows are ignored."""

import os
import tempfile
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from oracle import compare
from trustframe.plans import monitor_q
from trustframe.streaming import event_stream, latest_windows, run_hourly_monitor


def test_stream_equals_batch(spark, sf):
    ev = event_stream(spark, sf, "events.parquet")
    sink = run_hourly_monitor(spark, ev, monitor_q.LABEL(), monitor_q.PRED(), monitor_q.PRIV())
    got = latest_windows(spark, sink).toPandas()
    want = monitor_q.hourly(spark, sf).toPandas()
    assert compare(got, want) is None


def test_late_row_is_ignored(spark):
    """Three files, one micro-batch each. Spark drops input rows that are older
    than the watermark of the previous batch, so the late row (5 h behind,
    watermark delay 2 h) arriving in the third batch never reaches a window."""
    import time
    d = tempfile.mkdtemp(prefix="tf-stream-")
    src = os.path.join(d, "src")
    t0 = datetime(2024, 1, 1, 10)
    schema = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
    files = [[(i, t0 + timedelta(minutes=10 * i), i, "view", 40.0, "{}") for i in range(6)],
             [(101, t0 + timedelta(hours=1, minutes=5), 8, "view", 10.0, "{}")],
             [(100, t0 - timedelta(hours=5), 7, "purchase", 40.0, "{}")]]
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)  # distinct modification times -> one file per batch, in order
    ev = event_stream(spark, src, "*.parquet", max_files_per_trigger=1)
    sink = run_hourly_monitor(spark, ev, monitor_q.LABEL(), monitor_q.PRED(), monitor_q.PRIV())
    out = latest_windows(spark, sink)
    starts = sorted(r.window_start for r in out.collect())
    assert starts == [t0, t0 + timedelta(hours=1)]  # the late row's window never appears
    assert out.agg(F.sum("n")).first()[0] == 7
