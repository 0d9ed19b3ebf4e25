"""Stateful streams: the same rows however files fall into micro-batches and after a restart; old state and old days go."""

import os
import shutil
import tempfile
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from oracle import compare, duck
from trustframe.operators import drift as dr
from trustframe.plans import stream_q
from trustframe.plans.registry import ORACLE
from trustframe.functions.exprs import round_doubles
from trustframe.sources import sinks as sk
from trustframe.streaming import (drift_alerts_by_window, event_stream, final_histograms, to_files, violation_runs, windows_stream)

T0 = datetime(2024, 1, 1)
SCHEMA = "series string, window_start timestamp, window_end timestamp, bad boolean"


def new_dir(name):
    return tempfile.mkdtemp(prefix=f"tf-{name}-")


def put(spark, path, rows):
    """One more file of windows: (series, hour, failed)."""
    rows = [(s, T0 + timedelta(hours=h), T0 + timedelta(hours=h + 1), bad) for s, h, bad in rows]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def runs(spark, sink, base, files=1, **kw):
    out = to_files(violation_runs(windows_stream(spark, sink, files), F.col("bad"), ["series"], **kw), base, name="runs", idle_batches=False)
    got = spark.read.schema("series string, window_start timestamp, run_length int").parquet(out).collect()
    return sorted((r.series, (r.window_start - T0) / timedelta(hours=1), r.run_length) for r in got)


@pytest.fixture(scope="module")
def arriving(spark, sf):
    return stream_q.events_in_files(spark, sf, 7).removeprefix("file:")


def test_files_per_trigger_do_not_change_runs(spark, sf, arriving):
    def go(files, sink_files):
        base = new_dir("runs")
        sink = stream_q.type_windows(spark, arriving, base, files)
        out = to_files(violation_runs(windows_stream(spark, sink, sink_files), stream_q.type_fails(), ["event_type"]), base, name="runs", idle_batches=False)
        got = spark.read.schema("event_type string, window_start timestamp, run_length int").parquet(out)
        return got.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).toPandas()
    want = duck(sf).execute(ORACLE["stream_violation_runs"]).df()
    assert len(want) > 5
    assert compare(go(7, 100), want) is None
    assert compare(go(3, 1), want) is None


def test_restart_goes_on_where_it_stopped(spark, sf, arriving):
    """Four files, a stop, three more files: equal to one run, for the windows, the runs and the drift."""
    part = new_dir("part")
    files = sorted((f for f in os.listdir(arriving) if f.endswith(".parquet")), key=lambda f: os.stat(f"{arriving}/{f}").st_mtime_ns)
    assert len(files) == 7
    base, source = f"{part}/base", f"{part}/src"
    os.mkdir(source)
    got = None
    for some in (files[:4], files[4:]):
        for f in some:
            shutil.copy2(f"{arriving}/{f}", f"{source}/{f}")
        sink = stream_q.type_windows(spark, source, base, 2)
        got = to_files(violation_runs(windows_stream(spark, sink, 1), stream_q.type_fails(), ["event_type"]), base, name="runs", idle_batches=False)
        days = to_files(final_histograms(event_stream(spark, source, "*.parquet", 1), ["value", "user_id"], ["event_type"]), base, name="days")
    got = spark.read.schema("event_type string, window_start timestamp, run_length int").parquet(got)
    assert compare(got.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).toPandas(),
                   duck(sf).execute(ORACLE["stream_violation_runs"]).df()) is None
    ref = spark.read.parquet(f"{sf}/events.parquet").where(F.col("ts") < F.lit(stream_q.drift_q.CUT).cast("timestamp")).select(
        "value", F.col("user_id").cast("double").alias("user_id"), "event_type")
    dr.reference_profile(ref, ["value", "user_id"], ["event_type"]).write.parquet(f"{base}/profile")
    d = drift_alerts_by_window(spark.read.parquet(f"{base}/profile"), spark.read.parquet(days))
    d = round_doubles(d.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))
    assert compare(d.toPandas(), duck(sf).execute(ORACLE["stream_windowed_drift"]).df()) is None


def test_runs_gaps_repeats_and_missing_verdicts(spark):
    path = new_dir("windows") + "/w"
    put(spark, path, [("a", 0, True), ("a", 1, True), ("b", 0, True), ("c", 0, None), ("d", 0, True), ("d", 1, True)])
    put(spark, path, [("a", 2, False), ("a", 3, True), ("b", 1, True), ("b", 0, True), ("c", 1, True), ("c", 2, True)])
    # a run goes on over three files; d's gap is longer than the retention; b's first window came twice
    put(spark, path, [("a", 4, True), ("a", 5, True), ("a", 6, True), ("b", 2, True), ("c", 3, True), ("d", 30, True)])
    want = [("a", 5.0, 3), ("b", 2.0, 3), ("c", 3.0, 3)]
    assert runs(spark, path, new_dir("one"), 1, retention_hours=24) == want
    assert runs(spark, path, new_dir("all"), 10, retention_hours=24) == want


def state(spark, base):
    t = spark.read.format("statestore").option("stateVarName", "run").load(f"{base}/_runs")
    return sorted(r[0] for r in t.select("key.series").collect())


def test_old_state_goes_and_new_state_stays(spark):
    path, base, ttl = new_dir("windows") + "/w", new_dir("state"), {"state_ttl": timedelta(seconds=20)}
    put(spark, path, [("old", 0, True), ("old", 1, True), ("new", 0, True), ("new", 1, False)])
    assert runs(spark, path, base, **ttl) == []
    assert state(spark, base) == ["new", "old"]
    time.sleep(12)
    put(spark, path, [("new", 2, True), ("new", 3, True)])
    runs(spark, path, base, **ttl)
    time.sleep(12)
    put(spark, path, [("new", 4, True)])
    assert runs(spark, path, base, **ttl) == [("new", 4.0, 3)]
    assert state(spark, base) == ["new"]
    # the forgotten run does not go on
    put(spark, path, [("old", 2, True)])
    assert runs(spark, path, base, **ttl) == [("new", 4.0, 3)]
    assert state(spark, base) == ["new", "old"]


def test_whole_days_expire(spark):
    path = new_dir("history") + "/h"
    rows = [(i, T0 + timedelta(hours=6 * i)) for i in range(40)]  # ten days
    sk.append_history(spark.createDataFrame(rows, "id int, ts timestamp"), path)
    as_of = T0 + timedelta(days=10)
    assert sk.expire_history(spark, path, as_of, 7 * 24) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert sk.expire_history(spark, path, as_of, 7 * 24) == []
    assert sk.expire_history(spark, path, as_of + timedelta(hours=23), 7 * 24) == []  # the day of the limit stays whole
    left = spark.read.parquet(path)
    assert left.count() == 28 and left.agg(F.min("id")).first()[0] == 12
    sk.append_history(spark.createDataFrame([(99, T0)], "id int, ts timestamp"), path)
    assert sk.expire_history(spark, path, as_of, 7 * 24) == ["2024-01-01"]
    assert sk.expire_history(spark, path + "-none", as_of, 1) == []


def test_windows_against_a_profile_of_other_features(spark):
    profile = spark.createDataFrame([("x", "numeric", 1.0, None, 2), ("c", "categorical", None, "u", 4)],
                                    "feature string, kind string, v_num double, v_str string, n long")
    counts = spark.createDataFrame([(T0, "x", "numeric", 1.0, None, 5), (T0, "y", "numeric", 3.0, None, 5), (T0, "c", "numeric", 3.0, None, 1),
                                    (T0 + timedelta(days=1), "c", "categorical", None, "w", 2)],
                                   "window_start timestamp, feature string, kind string, v_num double, v_str string, n long")
    got = {(r.window_start, r.feature): r.drifted for r in dr.windowed_drift(profile, counts).collect()}
    assert got[T0, "x"] is False and got[T0 + timedelta(days=1), "c"] is True and (T0, "y") not in got


def test_slices_of_many_files_and_few_parts_of_state(spark, sf):
    """A slice dealt to several files is one micro-batch; the state has a part for each task, not for each shuffle partition."""
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        base = new_dir("parts")
        sink = stream_q.type_windows(spark, stream_q.events_in_files(spark, sf, 7, 3), base, 3)
        out = to_files(violation_runs(windows_stream(spark, sink, 2), stream_q.type_fails(), ["event_type"]), base, name="runs", idle_batches=False, partitions=2)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "23"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    numbers = lambda name: {d for d in os.listdir(f"{base}/_{name}/state/0") if d.isdigit()}
    assert len(numbers("windows")) == spark.sparkContext.defaultParallelism and len(numbers("runs")) == 2
    got = spark.read.schema("event_type string, window_start timestamp, run_length int").parquet(out)
    assert compare(got.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).toPandas(),
                   duck(sf).execute(ORACLE["stream_violation_runs"]).df()) is None


def test_slices_of_few_rows_have_as_many_files(spark):
    path = new_dir("few")
    rows = [(i, T0 + timedelta(hours=9 * (i > 7)), i, "a", 1.0, "{}") for i in range(9)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{path}/events.parquet")
    source = stream_q.events_in_files(spark, path, 3, 4)
    assert len(spark.read.parquet(source).inputFiles()) == 12
    assert sorted(r.event_id for r in spark.read.parquet(source).collect()) == list(range(9))
