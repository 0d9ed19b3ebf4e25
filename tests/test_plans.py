"""Plan audit: no registered query may plan a cartesian product, a
nested-loop join or a row-at-a-time Python UDF."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from trustframe.operators import encode, explain, monitor, sampling

# the training-data queries have tests of their own
QUERIES = {k: v for k, v in E.queries().items() if not re.match(r"op\d+_|pipeline$", k)}
# model fits and streams run jobs while they are built; their plans are
# checked through the operators they share with the batch queries
SKIP = {"train_logreg", "train_forest", "train_gbt", "train_logreg_cv", "model_save_load",
        "text_classifier", "stream_monitor", "stream_consecutive_violations",
        "stream_drift_alerts"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_plan_has_no_forbidden_operators(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    bad = [op for op in FORBIDDEN if op in plan]
    assert not bad, f"{name}: {bad}"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_surrogates_and_scaling_do_not_shuffle(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    lime = explain.lime_tabular(o, "o_orderkey", ["o_totalprice", "o_custkey"], lambda z: z["o_totalprice"] * 2 + z["o_custkey"],
                                {"o_totalprice": 1.0, "o_custkey": 1.0}, n_samples=20)
    text = explain.lime_text(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "text", lambda t: F.size(t) * 1.0, n_samples=8)
    shap = explain.sampled_shapley(o, o.limit(5), "o_orderkey", ["o_totalprice", "o_custkey"], lambda z: z["o_totalprice"] * z["o_custkey"], 4)
    scaled = encode.fit_encoder(o, ["o_totalprice"], ["o_orderstatus"]).transform(o)
    for df in (lime, text, shap, scaled):
        p = plan_of(df)
        assert "Exchange" not in p and "Python" not in p and "MapInPandas" not in p
        assert p.count("Scan parquet") == 1 or p.count("FileScan parquet") == 1


def test_sliding_windows_expand_counts_not_rows(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    w = monitor.window_metrics(e, "ts", F.col("value") > 1, F.col("value") > 2, F.col("user_id") % 2 == 0, "24 hours", "1 hour")
    p = plan_of(w)
    assert p.count("FileScan parquet") == 1
    below = p[p.rindex("Expand"):] if "Expand" in p else ""
    assert "HashAggregate" in below  # the rows are aggregated before windows are expanded


def test_row_tables_do_not_meet_in_one_task(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    for df in (sampling.oversample(o, "o_orderstatus", "o_orderkey"), sampling.stratified_split(o, ["o_orderstatus"], "o_orderkey")):
        assert "SinglePartition" not in plan_of(df)
