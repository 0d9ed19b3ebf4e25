"""Queries of the fitted stages, the folds and the latency sketches."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from trustframe.operators import monitor as mo
from trustframe.operators import sampling as sm
from trustframe.operators import stages as st
from trustframe.plans.registry import T, register, rnd
from trustframe.plans.sampling_q import key_sql, split_sql
from trustframe.session import cut_lineage, ensure_checkpoint_dir

_HOLES = """(SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS cust, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS priority FROM orders)"""


def holes(spark, sf):
    k = F.col("o_orderkey")
    return T(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.when(k % 7 != 0, F.col("o_totalprice")).alias("price"),
                                         F.when(k % 11 != 0, F.col("o_custkey")).alias("cust"), F.when(k % 5 != 0, F.col("o_orderpriority")).alias("priority"))


@register("impute_fit_train", rnd(f"""
WITH s AS MATERIALIZED ({split_sql(_HOLES, "o_orderkey, price, cust, priority", "o_orderstatus", "o_orderkey")}),
m AS (SELECT median(price) AS price, median(cust) AS cust FROM s WHERE split = 'train'),
p AS (SELECT priority FROM s WHERE split = 'train' AND priority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT o_orderkey, split, coalesce(s.price, m.price) AS price, coalesce(s.cust, trunc(m.cust)::BIGINT) AS cust,
       coalesce(s.priority, p.priority) AS priority FROM s, m, p""", ["price"]))
def impute_fit_train(spark, sf):
    """X1 with statistics of the train split alone, applied to all splits."""
    s = cut_lineage(sm.stratified_split(holes(spark, sf), ["o_orderstatus"], "o_orderkey", 42))
    m = st.TableImputer(numericCols=["price", "cust"], categoricalCols=["priority"]).fit(s.where("split = 'train'"))
    return m.transform(s).select("o_orderkey", "split", "price", "cust", "priority")


def churn(spark, sf):
    """Orders with a label that price, day and priority tell in part."""
    o = T(spark, sf, "orders")
    y = (F.col("o_totalprice") + 40000.0 * (F.col("o_orderkey") % 7) > 300000.0).cast("double")
    return o.select("o_orderkey", "o_totalprice", F.dayofmonth("o_orderdate").cast("double").alias("day"), "o_orderpriority", y.alias("y"))


_CHURN = "(SELECT o_orderkey, (o_totalprice + 40000.0 * (o_orderkey % 7) > 300000.0)::INT AS y FROM orders)"


def pipeline(c: float = 1.0, n: int = 1000) -> Pipeline:
    return Pipeline(stages=[st.TableImputer(numericCols=["o_totalprice", "day"], categoricalCols=["o_orderpriority"]),
                            st.TableEncoder(numericCols=["o_totalprice", "day"], categoricalCols=["o_orderpriority"]),
                            LogisticRegression(labelCol="y", featuresCol="features", maxIter=30, regParam=1.0 / (c * n))])


@register("pipeline_save_load", f"""
SELECT split, count(*)::BIGINT AS n, sum(y)::BIGINT AS n_pos, 0.0::DOUBLE AS max_difference, 6::INT AS width
FROM ({split_sql(_CHURN, "o_orderkey, y", "y", "o_orderkey")}) s GROUP BY split""")
def pipeline_save_load(spark, sf):
    """X5 + S7: imputer, encoder and classifier fitted as one pipeline, saved, loaded: equal scores in every split."""
    s = cut_lineage(sm.stratified_split(churn(spark, sf), ["y"], "o_orderkey", 42))
    m = pipeline().fit(s.where("split = 'train'"))
    path = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    m.write().overwrite().save(path)
    m2 = PipelineModel.load(path)
    score = lambda x: x.transform(s).select("o_orderkey", "split", "y", vector_to_array("features").alias("f"), vector_to_array("probability")[1].alias("p"))
    both = score(m).join(score(m2).select("o_orderkey", F.col("p").alias("q"), F.size("f").alias("w")), "o_orderkey")
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("y").cast("long").alias("n_pos"),
                                     F.max(F.abs(F.col("p") - F.col("q"))).alias("max_difference"), F.max("w").alias("width"))


def folds_sql(src: str, cols: str, strata: str, id_col: str, k: int) -> str:
    cuts = " ".join(f"WHEN rn <= (n * {i + 1}) // {k} THEN {i}" for i in range(k - 1))
    return f"""
SELECT {cols}, CASE {cuts} ELSE {k - 1} END::INT AS fold FROM (SELECT *, row_number() OVER (PARTITION BY {strata} ORDER BY {key_sql(id_col)}, {id_col}) AS rn,
  count(*) OVER (PARTITION BY {strata}) AS n FROM {src} s) r"""


@register("stratified_folds", folds_sql(_CHURN, "o_orderkey, y", "y", "o_orderkey", 5))
def stratified_folds(spark, sf):
    """Exact stratified folds in seeded order."""
    d = churn(spark, sf).select("o_orderkey", F.col("y").cast("int").alias("y"))
    return st.stratified_folds(d, ["y"], "o_orderkey", 5)


@register("cv_fold_scores", f"""
WITH f AS ({folds_sql(_CHURN, "o_orderkey, y", "y", "o_orderkey", 5)})
SELECT fold, count(*)::BIGINT AS n, sum(y)::BIGINT AS n_pos, true AS f1_equal, true AS summary_equal, true AS better_than_constant FROM f GROUP BY fold""")
def cv_fold_scores(spark, sf):
    """A21 with L1: out-of-fold predictions, the pipeline refitted in each fold, stored; weighted F1 per fold, its mean and
    population spread recomputed from the stored rows equal the ML evaluator's, and beat the better constant."""
    d = cut_lineage(st.stratified_folds(churn(spark, sf), ["y"], "o_orderkey", 5))
    s = cut_lineage(st.fold_scores(d, pipeline(), "fold", "y", "o_orderkey"))
    ev = MulticlassClassificationEvaluator(labelCol="y", metricName="f1")
    cv = st.cross_validate_folds(d, pipeline(), ParamGridBuilder().build(), ev, "fold", 5)
    per = cut_lineage(st.weighted_f1(s, "y", ["fold"]), large=False)
    const = st.weighted_f1(s.select("y", "fold", F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("prediction")), "y", ["fold", "prediction"])
    const = const.groupBy("fold").agg(F.max("f1_weighted").alias("const"))
    # one row per fold
    want = spark.createDataFrame([(i, float(ev.evaluate(s.where(F.col("fold") == i)))) for i in range(5)], "fold int, want double")
    m = per.agg(F.avg("f1_weighted").alias("m"), F.stddev_pop("f1_weighted").alias("s")).first()
    same = abs(m["m"] - cv.avgMetrics[0]) < 1e-9 and abs(m["s"] - cv.stdMetrics[0]) < 1e-9
    pos = s.groupBy("fold").agg(F.sum("y").cast("long").alias("n_pos"))
    return per.join(want, "fold").join(const, "fold").join(pos, "fold").select(
        "fold", "n", "n_pos", (F.abs(F.col("f1_weighted") - F.col("want")) < 1e-9).alias("f1_equal"), F.lit(same).alias("summary_equal"),
        (F.col("f1_weighted") > F.col("const")).alias("better_than_constant"))


_SKETCH_Q = (0.5, 0.9, 0.99)


@register("latency_percentiles", f"""
WITH q AS (SELECT unnest([{", ".join(str(x) for x in _SKETCH_Q)}])::DOUBLE AS q)
SELECT strftime(ts, '%Y-%m-%d') AS day, q, count(value)::BIGINT AS n, true AS within_error FROM events, q GROUP BY 1, 2""")
def latency_percentiles(spark, sf):
    """Quantile sketches stored by hour and merged by day; every estimate's rank in the day's rows lies within the
    stated error of the quantile."""
    log = T(spark, sf, "events")
    hours = cut_lineage(mo.latency_sketches(log, "ts", "value"))
    est = mo.latency_percentiles(hours, _SKETCH_Q)
    rows = log.where(F.col("value").isNotNull()).select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "value")
    r = rows.join(F.broadcast(est), "day").groupBy("day", "q", "n").agg(  # a row per day and quantile
        F.count_if(F.col("value") < F.col("estimate")).alias("below"), F.count_if(F.col("value") <= F.col("estimate")).alias("upto"))
    ok = (F.col("below") <= (F.col("q") + mo.SKETCH_ERROR) * F.col("n")) & (F.col("upto") >= (F.col("q") - mo.SKETCH_ERROR) * F.col("n"))
    return r.select("day", "q", "n", ok.alias("within_error"))
