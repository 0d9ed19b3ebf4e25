"""Source, sink and repair queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from trustframe.operators import fairness as fz
from trustframe.operators import repair as rp
from trustframe.operators import sampling as sm
from trustframe.operators import validate as va
from trustframe.operators import drift as dr
from trustframe.plans import bindings as B
from trustframe.plans import drift_q, fairness_q, monitor_q, sampling_q
from trustframe.plans.registry import T, register, rnd
from trustframe.functions.joins import combine_rows
from trustframe.session import ensure_checkpoint_dir
from trustframe.sources import readers, sinks


def _scratch(spark, what):
    return f"{ensure_checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"


@register("repair_quantile", rnd("""
WITH h AS (SELECT o_orderstatus AS grp, o_totalprice AS v, count(*)::BIGINT AS c FROM orders
           WHERE o_totalprice IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY 1, 2),
c AS (SELECT grp, v, c, (sum(c) OVER (PARTITION BY grp ORDER BY v))::BIGINT AS cum,
        (sum(c) OVER (PARTITION BY grp))::BIGINT AS n FROM h),
q AS (SELECT grp, v, unnest(generate_series((cum - c) * 100 // n + 1, cum * 100 // n)) AS i FROM c
      WHERE (cum - c) * 100 // n + 1 <= cum * 100 // n),
t AS (SELECT i, median(v) AS repaired FROM q GROUP BY i),
k AS (SELECT grp, v, (cum * 100 + n - 1) // n AS i FROM c)
SELECT o.o_orderkey, o.o_orderstatus, o.o_totalprice, t.repaired
FROM orders o LEFT JOIN k ON o.o_orderstatus = k.grp AND o.o_totalprice = k.v LEFT JOIN t ON k.i = t.i""",
    ["o_totalprice", "repaired"]))
def repair_quantile(spark, sf):
    """Full disparate-impact repair of o_totalprice across o_orderstatus."""
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return rp.quantile_repair(o, "o_totalprice", "o_orderstatus", 100)


@register("cached_group_rates", fairness_q.ORACLE_GROUP_RATES)
def cached_group_rates(spark, sf):
    """Result materialised as Parquet under md5(path + params), reused
    when complete."""
    build = lambda: fz.group_confusion(T(spark, sf, "lineitem"), B.LI_ATTRS, B.LI_LABEL(),  # noqa
                                       B.LI_PRED())
    root = f"{ensure_checkpoint_dir(spark)}/cache"
    return sinks.cached_result(spark, root, f"{sf}/lineitem.parquet",
                               {"op": "group_confusion", "attrs": ["l_linestatus"]}, build)


@register("splits_roundtrip", f"""
SELECT * FROM ({sampling_q.split_sql("orders", "o_orderkey, o_orderstatus", "o_orderstatus",
                                     "o_orderkey")}) s WHERE split = 'test'""")
def splits_roundtrip(spark, sf):
    """Split table written partitioned by split; the test split read back
    (partition pruning)."""
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    path = _scratch(spark, "splits")
    sinks.save_splits(sm.stratified_split(o, ["o_orderstatus"], "o_orderkey", 42), path)
    return sinks.load_splits(spark, path, "test").select("o_orderkey", "o_orderstatus", "split")


@register("parse_requests", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def parse_requests(spark, sf):
    """JSON request rows parsed with an explicit schema."""
    ev = T(spark, sf, "events").select("event_id", "props")
    return sinks.parse_requests(ev, "props", "k bigint").select("event_id", "k")


@register("history_append", rnd(monitor_q.HOURLY_SQL, monitor_q._WCOLS))
def history_append(spark, sf):
    """Hourly monitor rows appended to a history table partitioned by
    day and read back."""
    path = _scratch(spark, "history")
    sinks.append_history(monitor_q.hourly(spark, sf), path, "window_start")
    return spark.read.parquet(path).drop("date")


@register("dataset_registry", sampling_q.ORACLE_BIAS)
def dataset_registry(spark, sf):
    """S4 + S5: dataset loaded by name from a config map, with bias injection."""
    cfg = {"data": {"orders": f"{sf}/orders.parquet"}}
    df = readers.load_dataset(spark, "orders", cfg, apply_bias=True, bias_attr="o_orderstatus",
                              id_col="o_orderkey")
    return df.select("o_orderkey", "o_orderstatus", "bias_group", "copy")


@register("group_label_sizes", """
SELECT o_orderstatus, y, count(*)::BIGINT AS n, min(count(*)) OVER ()::BIGINT AS min_cell FROM
  (SELECT o_orderstatus, CAST(o_totalprice > 250000 AS INTEGER) AS y FROM orders) c GROUP BY 1, 2""")
def group_label_sizes(spark, sf):
    """(attribute, label) cell sizes and the smallest cell."""
    c = T(spark, sf, "orders").select("o_orderstatus",
                                      (F.col("o_totalprice") > 250000).cast("int").alias("y"))
    g = c.groupBy("o_orderstatus", "y").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("min_cell", F.lit(g.agg(F.min("n")).first()[0]))  # one number


@register("fairness_overall_gate", f"""
SELECT bool_and(overall_pass) AS overall_pass, count_if(NOT overall_pass)::BIGINT AS n_failed_attrs
FROM ({fairness_q.sql_verdict(fairness_q.sql_gates(B.ORD_SQL, "pairwise"))}) v""")
def fairness_overall_gate(spark, sf):
    """F12 + F16: run-level strict gate over all attributes (a failed or
    unevaluated attribute fails the run)."""
    v = fairness_q.fairness_verdict(spark, sf)
    return fz.run_gate(v, [a.name for a in B.ORD_ATTRS])


_SUMMARY_SQL = f"""
SELECT 'fairness' AS stage, printf('fairness %s: %s (%s)', attr,
  CASE WHEN overall_pass THEN 'PASS' ELSE 'FAIL' END, failed_metrics) AS line
FROM ({fairness_q.sql_verdict(fairness_q.sql_gates(B.ORD_SQL, "pairwise"))}) v
UNION ALL
SELECT 'drift', printf('drift: overall %.4f, detected=%s', overall_score, CAST(drift_detected AS VARCHAR))
FROM (SELECT avg(score) AS overall_score, avg(score) > 0.1 AS drift_detected
      FROM ({drift_q.features_sql()}) f) d
UNION ALL
SELECT 'validation', printf('validation: %d rows, class ratio %.4f', sum(n), min(n) / max(n))
FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderstatus) c"""


@register("run_summary", _SUMMARY_SQL, rounded=False)
def run_summary(spark, sf):
    """S11 + S12: run report rows written as JSON lines and read back."""
    v = fairness_q.fairness_verdict(spark, sf).select(
        F.lit("fairness").alias("stage"),
        F.format_string("fairness %s: %s (%s)", "attr",
                        F.when(F.col("overall_pass"), "PASS").otherwise("FAIL"),
                        "failed_metrics").alias("line"))
    ref, cur = drift_q.halves(spark, sf)
    d = dr.overall_drift(dr.feature_drift(ref.drop("pred"), cur.drop("pred"))).select(
        F.lit("drift").alias("stage"),
        F.format_string("drift: overall %.4f, detected=%s", "overall_score",
                        F.col("drift_detected").cast("string")).alias("line"))
    r = va.class_ratio(va.class_distribution(T(spark, sf, "orders"), "o_orderstatus"))
    n = va.class_distribution(T(spark, sf, "orders"), "o_orderstatus").agg(F.sum("n").alias("n"))
    val = combine_rows(n, r).select(
        F.lit("validation").alias("stage"),
        F.format_string("validation: %d rows, class ratio %.4f", "n", "class_ratio").alias("line"))
    path = _scratch(spark, "report")
    sinks.write_report(v.unionByName(d).unionByName(val), path)
    return spark.read.schema("stage string, line string").json(path)
