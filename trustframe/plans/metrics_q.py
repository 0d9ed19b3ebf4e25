"""Model metric and scoring queries with fixed linear scorers (A11-A13,
A21, F17, F18, L5, L6, L8, L11, L12)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from trustframe.operators import metrics as mt
from trustframe.operators import scoring as sc
from trustframe.plans.registry import T, register, rnd

# Fixed scorer over lineitem numerics (a stand-in for a fitted linear model).
LI_COEF = {"l_quantity": 0.03, "l_discount": 8.0, "l_tax": -5.0, "l_extendedprice": -0.00001}
LI_B = -0.9
AS_OF = datetime(2024, 2, 1)


def margin_sql(coef=LI_COEF, b=LI_B) -> str:
    return f"({b} + " + " + ".join(f"({v}) * CAST({k} AS DOUBLE)" for k, v in coef.items()) + ")"


def prob_sql(coef=LI_COEF, b=LI_B) -> str:
    return f"(1.0 / (1.0 + exp(-{margin_sql(coef, b)})))"


SCORED_SQL = f"""(SELECT l_orderkey, l_linenumber, l_linestatus,
  CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS rid,
  CAST(l_returnflag = 'R' AS INTEGER) AS y, {prob_sql()} AS p,
  CAST({prob_sql()} >= 0.5 AS INTEGER) AS yhat FROM lineitem)"""


def scored(spark, sf, coef=LI_COEF, b=LI_B):
    li = T(spark, sf, "lineitem")
    p = sc.sigmoid(sc.linear_margin(coef, b))
    return li.select("l_orderkey", "l_linenumber", "l_linestatus",
                     F.concat_ws("-", F.col("l_orderkey").cast("string"),
                                 F.col("l_linenumber").cast("string")).alias("rid"),
                     (F.col("l_returnflag") == "R").cast("int").alias("y"), p.alias("p"),
                     (p >= 0.5).cast("int").alias("yhat"))


def confusion_sql(src: str, by: str = "") -> str:
    g = f"{by}, " if by else ""
    gb = f"GROUP BY {by}" if by else ""
    return f"""
SELECT {g}n, tp, fp, tn, fn,
  CASE WHEN n > 0 THEN (tp + tn)::DOUBLE / n ELSE 0.0 END AS accuracy,
  CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0.0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN (2 * tp)::DOUBLE / (2 * tp + fp + fn) ELSE 0.0 END AS f1
FROM (SELECT {g}count(*)::BIGINT AS n, count_if(y = 1 AND yhat = 1)::BIGINT AS tp,
        count_if(y = 0 AND yhat = 1)::BIGINT AS fp, count_if(y = 0 AND yhat = 0)::BIGINT AS tn,
        count_if(y = 1 AND yhat = 0)::BIGINT AS fn FROM {src} s {gb}) c"""


_CM = ["accuracy", "precision", "recall", "f1"]


@register("confusion_metrics", rnd(confusion_sql(SCORED_SQL), _CM))
def confusion_metrics(spark, sf):
    """A11 + A12 + L5: confusion counts and accuracy/precision/recall/F1."""
    return mt.confusion(scored(spark, sf), "y", "yhat")


def auc_sql(src: str, by: str | None) -> str:
    k = by if by else "'*'"
    sel = f"key AS {by}, " if by else ""
    return f"""
WITH h AS (SELECT {k} AS key, p AS s, count_if(y = 1) AS pos, count_if(y = 0) AS neg
           FROM {src} x GROUP BY 1, 2),
c AS (SELECT key, pos, neg, sum(neg) OVER (PARTITION BY key ORDER BY s) - neg AS below FROM h)
SELECT {sel}sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg,
  CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) END AS auc
FROM c GROUP BY key"""


@register("roc_auc", rnd(auc_sql(SCORED_SQL, None), ["auc"]))
def roc_auc(spark, sf):
    """Exact ROC-AUC, ties count one half."""
    return mt.roc_auc(scored(spark, sf), "y", "p")


@register("roc_auc_by_group", rnd(auc_sql(SCORED_SQL, "l_linestatus"), ["auc"]))
def roc_auc_by_group(spark, sf):
    """A13 per protected group."""
    return mt.roc_auc(scored(spark, sf), "y", "p", "l_linestatus")


MODELS = {"linear_all": (LI_COEF, LI_B), "discount_only": ({"l_discount": 10.0}, -0.5),
          "quantity_only": ({"l_quantity": 0.05}, -1.3)}


def _long_sql():
    parts = []
    for name, (coef, b) in MODELS.items():
        parts.append(f"SELECT '{name}' AS model, CAST(l_returnflag = 'R' AS INTEGER) AS y, "
                     f"CAST({prob_sql(coef, b)} >= 0.5 AS INTEGER) AS yhat FROM lineitem")
    return "(" + " UNION ALL ".join(parts) + ")"


@register("model_compare", rnd(f"""
WITH m AS ({confusion_sql(_long_sql(), 'model')})
SELECT m.*, model = (SELECT model FROM m ORDER BY f1 DESC, model LIMIT 1) AS best FROM m""", _CM))
def model_compare(spark, sf):
    """Metrics per model; best = max F1 (ties -> name)."""
    li = T(spark, sf, "lineitem")
    preds = [F.struct(F.lit(n).alias("model"),
                      (sc.sigmoid(sc.linear_margin(c, b)) >= 0.5).cast("int").alias("yhat"))
             for n, (c, b) in MODELS.items()]
    long = li.select((F.col("l_returnflag") == "R").cast("int").alias("y"),
                     F.inline(F.array(*preds)))  # every model scored in one scan
    return mt.compare_models(long, "model", "y", "yhat")


@register("cv_summary", rnd(f"""
WITH f AS (SELECT *, CAST((('0x' || substring(md5(concat('42:', rid)), 1, 8))::BIGINT) % 5 AS INTEGER)
             AS fold FROM {SCORED_SQL} s),
per AS ({confusion_sql('f', 'fold')})
SELECT avg(f1) AS f1_mean, stddev_pop(f1) AS f1_std, count(*)::BIGINT AS n_folds FROM per""",
    ["f1_mean", "f1_std"]))
def cv_summary(spark, sf):
    """F1 per hash fold, mean and population std."""
    s = scored(spark, sf).withColumn("fold", mt.fold_of("rid", 5, 42))
    return mt.cv_summary(s, "fold", "y", "yhat")


@register("score_batch_linear", rnd(f"""
SELECT l_orderkey, l_linenumber, CAST(p >= 0.5 AS INTEGER) AS prediction, p AS probability,
  greatest(p, 1 - p) AS confidence, 'linear-v1' AS model_version,
  TIMESTAMP '2024-02-01 00:00:00' AS scored_at FROM {SCORED_SQL} s""", ["probability", "confidence"]))
def score_batch_linear(spark, sf):
    """L8 + L9: batch scoring record (a single request is the same job on one row)."""
    li = T(spark, sf, "lineitem")
    return sc.score_linear(li, LI_COEF, LI_B, ["l_orderkey", "l_linenumber"], "linear-v1", AS_OF)


@register("softmax_scores", rnd("""
WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: 3.0 * CAST(x AS DOUBLE)) AS sc
           FROM embeddings),
e AS (SELECT vec_id, list_transform(sc, lambda x: exp(x - list_max(sc))) AS ex FROM s),
p AS (SELECT vec_id, list_transform(ex, lambda x: x / list_sum(ex)) AS probs FROM e)
SELECT vec_id, CAST(list_position(probs, list_max(probs)) - 1 AS INTEGER) AS predicted_class,
  list_max(probs) AS confidence, list_sum(probs) AS prob_sum FROM p""", ["confidence", "prob_sum"]))
def softmax_scores(spark, sf):
    """Softmax over class scores (3 x the embedding, a class per dimension),
    argmax class and confidence."""
    e = T(spark, sf, "embeddings")
    scores = F.transform("embedding", lambda x: F.lit(3.0) * x.cast("double"))
    out = sc.class_prediction(e.select("vec_id", scores.alias("sc")), "sc", ["vec_id"])
    return out.select("vec_id", "predicted_class", "confidence",
                      F.aggregate("probs", F.lit(0.0), lambda a, x: a + x).alias("prob_sum"))


VOTERS = {"a": (1.0, -2.5), "b": (0.8, -2.0), "c": (1.2, -3.0)}


@register("soft_vote", rnd("SELECT o_orderkey, avg(p) AS probability, count(*)::BIGINT AS n_models, "
                           "CAST(avg(p) >= 0.5 AS INTEGER) AS prediction FROM (" + " UNION ALL ".join(
                               f"SELECT o_orderkey, 1.0 / (1.0 + exp(-({b} + {a} * o_totalprice / 100000.0)))"
                               f" AS p FROM orders" for a, b in VOTERS.values()) + ") v GROUP BY o_orderkey",
                           ["probability"]))
def soft_vote(spark, sf):
    """Soft voting = mean probability over models per row."""
    o = T(spark, sf, "orders")
    probs = [F.struct(F.lit(n).alias("model"),
                      sc.sigmoid(F.lit(b) + F.lit(a) * F.col("o_totalprice") / 100000.0)
                      .alias("probability")) for n, (a, b) in VOTERS.items()]
    long = o.select("o_orderkey", F.inline(F.array(*probs)))  # (row, model) scores, one scan
    return sc.soft_vote(long, "o_orderkey")


@register("calibration_by_group", rnd(f"""
SELECT l_linestatus AS grp, CAST(least(floor(p * 10), 9) AS INTEGER) AS bin, count(*)::BIGINT AS n,
  avg(p) AS mean_score, avg(CAST(y AS DOUBLE)) AS positive_rate FROM {SCORED_SQL} s GROUP BY 1, 2""",
    ["mean_score", "positive_rate"]))
def calibration_by_group(spark, sf):
    """calibration table per group and score decile."""
    return mt.calibration(scored(spark, sf), "p", "y", "l_linestatus", 10)


@register("threshold_by_group", rnd(f"""
WITH h AS (SELECT l_linestatus AS grp, CAST(least(greatest(floor(p * 100), 0), 99) AS INTEGER) AS cell,
             count(*) AS c FROM {SCORED_SQL} s GROUP BY 1, 2),
g AS (SELECT grp, unnest(range(0, 100)) AS cell FROM (SELECT DISTINCT grp FROM h) d),
f AS (SELECT g.grp, g.cell, coalesce(h.c, 0) AS c FROM g LEFT JOIN h ON g.grp = h.grp AND g.cell = h.cell),
r AS (SELECT grp, cell / 100.0 AS threshold,
        sum(c) OVER (PARTITION BY grp ORDER BY cell DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        / sum(c) OVER (PARTITION BY grp) AS selection_rate FROM f)
SELECT grp, threshold, selection_rate FROM (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY abs(selection_rate - 0.3), threshold) AS rk FROM r) x
WHERE rk = 1""", ["threshold", "selection_rate"]))
def threshold_by_group(spark, sf):
    """per-group threshold whose selection rate is closest to 0.3."""
    return mt.thresholds_by_group(scored(spark, sf), "p", "l_linestatus", 0.3)


@register("score_python_model", rnd(f"""
SELECT l_orderkey, l_linenumber, CAST(p >= 0.5 AS INTEGER) AS prediction, p AS probability,
  greatest(p, 1 - p) AS confidence, 'linear-v1' AS model_version,
  TIMESTAMP '2024-02-01 00:00:00' AS scored_at FROM {SCORED_SQL} s""", ["probability", "confidence"]))
def score_python_model(spark, sf):
    """L8 + UDF surface: a foreign Python model (predict_proba) scored by an
    iterator pandas UDF, one broadcast load per executor."""
    li = T(spark, sf, "lineitem")
    model = sc.LinearProbabilityModel(list(LI_COEF.values()), LI_B)
    return sc.score_python_model(li, model, list(LI_COEF), ["l_orderkey", "l_linenumber"],
                                 "linear-v1", AS_OF)
