"""Drift queries (D1-D9, A10, A16, A17, H1) on events: reference = before
2024-01-16, current = from 2024-01-16; ``*_shifted`` columns carry a derived
shift in the current half that must be detected."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from trustframe.operators import drift as dr
from trustframe.plans.registry import T, register, rnd

CUT = "2024-01-16 00:00:00"
NUM = ["value", "user_id", "value_shifted"]
CAT = ["event_type", "event_type_shifted"]

REF_SQL = f"""(SELECT value, CAST(user_id AS DOUBLE) AS user_id, value AS value_shifted, event_type,
  event_type AS event_type_shifted, CAST(value > 25 AS INTEGER) AS pred
  FROM events WHERE ts < TIMESTAMP '{CUT}')"""
CUR_SQL = f"""(SELECT value, CAST(user_id AS DOUBLE) AS user_id, value * 1.5 AS value_shifted, event_type,
  CASE WHEN event_type = 'purchase' AND user_id % 2 = 0 THEN 'refund' ELSE event_type END
    AS event_type_shifted, CAST(value * 1.5 > 25 AS INTEGER) AS pred
  FROM events WHERE ts >= TIMESTAMP '{CUT}')"""


def halves(spark, sf):
    ev = T(spark, sf, "events")
    cut = F.lit(CUT).cast("timestamp")
    ref = ev.where(F.col("ts") < cut).select(
        "value", F.col("user_id").cast("double").alias("user_id"),
        F.col("value").alias("value_shifted"), "event_type",
        F.col("event_type").alias("event_type_shifted"),
        (F.col("value") > 25).cast("int").alias("pred"))
    cur = ev.where(F.col("ts") >= cut).select(
        "value", F.col("user_id").cast("double").alias("user_id"),
        (F.col("value") * 1.5).alias("value_shifted"), "event_type",
        F.when((F.col("event_type") == "purchase") & (F.col("user_id") % 2 == 0), F.lit("refund"))
        .otherwise(F.col("event_type")).alias("event_type_shifted"),
        (F.col("value") * 1.5 > 25).cast("int").alias("pred"))
    return ref, cur


def num_sql(cols=NUM, ref=REF_SQL, cur=CUR_SQL) -> str:
    parts = []
    for c in cols:
        parts.append(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, 0 AS side FROM {ref} r")
        parts.append(f"SELECT '{c}', CAST({c} AS DOUBLE), 1 FROM {cur} c")
    return f"""
WITH l AS ({" UNION ALL ".join(parts)}),
l2 AS (SELECT * FROM l WHERE v IS NOT NULL AND NOT isnan(v)),
h AS (SELECT feature, v, count_if(side = 0) AS cr, count_if(side = 1) AS cc FROM l2 GROUP BY feature, v),
t AS (SELECT feature, v, sum(cr) OVER w AS cum_r, sum(cc) OVER w AS cum_c, lead(v) OVER w AS nv
      FROM h WINDOW w AS (PARTITION BY feature ORDER BY v)),
tot AS (SELECT feature, sum(cr) AS nr, sum(cc) AS nc, min(v) AS lo, max(v) AS hi,
          sum(v * cr) / sum(cr) AS mr, sum(v * cc) / sum(cc) AS mc FROM h GROUP BY feature),
sd AS (SELECT feature, stddev_samp(v) AS s FROM l2 WHERE side = 0 GROUP BY feature),
agg AS (SELECT t.feature, sum(abs(cum_r / tot.nr - cum_c / tot.nc) * coalesce(nv - v, 0.0)) AS area,
          max(abs(cum_r / tot.nr - cum_c / tot.nc)) AS ks FROM t JOIN tot USING (feature) GROUP BY t.feature)
SELECT tot.feature, nr::BIGINT AS n_ref, nc::BIGINT AS n_cur, lo, hi,
  CASE WHEN nr = 0 OR nc = 0 OR hi = lo THEN 0.0 ELSE area / (hi - lo) END AS wasserstein,
  CASE WHEN nr = 0 OR nc = 0 THEN 0.0 ELSE ks END AS ks,
  abs(mr - mc) / sd.s AS mean_shift
FROM tot JOIN agg USING (feature) LEFT JOIN sd USING (feature)"""


def shares_sql(cols=CAT, ref=REF_SQL, cur=CUR_SQL) -> str:
    parts = []
    for c in cols:
        parts.append(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS v, 0 AS side FROM {ref} r")
        parts.append(f"SELECT '{c}', CAST({c} AS VARCHAR), 1 FROM {cur} c")
    return f"""
WITH l AS (SELECT * FROM ({" UNION ALL ".join(parts)}) x WHERE v IS NOT NULL),
h AS (SELECT feature, v, count_if(side = 0)::BIGINT AS cnt_ref, count_if(side = 1)::BIGINT AS cnt_cur
      FROM l GROUP BY feature, v),
tot AS (SELECT feature, sum(cnt_ref) AS nr, sum(cnt_cur) AS nc FROM h GROUP BY feature)
SELECT feature, v AS category, cnt_ref, cnt_cur,
  CASE WHEN cnt_ref > 0 THEN cnt_ref / nr ELSE 0.001 END AS share_ref,
  CASE WHEN cnt_cur > 0 THEN cnt_cur / nc ELSE 0.001 END AS share_cur
FROM h JOIN tot USING (feature)"""


def cat_sql(cols=CAT, ref=REF_SQL, cur=CUR_SQL) -> str:
    return f"""
SELECT feature, count(*)::BIGINT AS n_categories,
  abs(sum((share_cur - share_ref) * ln(share_cur / share_ref))) AS psi,
  sum(share_cur * ln(share_cur / share_ref)) AS kl,
  abs(sum((share_cur - share_ref) * ln(share_cur / share_ref))) > 0.2 AS psi_over_bound
FROM ({shares_sql(cols, ref, cur)}) s GROUP BY feature"""


def features_sql(num=NUM, cat=CAT, ref=REF_SQL, cur=CUR_SQL) -> str:
    return f"""
SELECT feature, 'wasserstein' AS method, wasserstein AS score, wasserstein > 0.1 AS drifted
FROM ({num_sql(num, ref, cur)}) n
UNION ALL
SELECT feature, 'psi', psi, psi > 0.1 FROM ({cat_sql(cat, ref, cur)}) c"""


@register("drift_wasserstein", rnd(f"SELECT feature, n_ref, n_cur, lo, hi, wasserstein FROM ({num_sql()}) q",
                                   ["lo", "hi", "wasserstein"]))
def drift_wasserstein(spark, sf):
    """D1 + A10 + H1: W1 of joint min-max scaled samples."""
    ref, cur = halves(spark, sf)
    return dr.numeric_drift(ref, cur, NUM).select("feature", "n_ref", "n_cur", "lo", "hi",
                                                  "wasserstein")


@register("drift_ks", rnd(f"SELECT feature, ks FROM ({num_sql()}) q", ["ks"]))
def drift_ks(spark, sf):
    """Kolmogorov-Smirnov statistic (max CDF gap) on the same histogram."""
    ref, cur = halves(spark, sf)
    return dr.numeric_drift(ref, cur, NUM).select("feature", "ks")


@register("drift_mean_shift", rnd(f"SELECT feature, mean_shift FROM ({num_sql()}) q", ["mean_shift"]))
def drift_mean_shift(spark, sf):
    """|mean_ref - mean_cur| / sample std of the reference."""
    ref, cur = halves(spark, sf)
    return dr.numeric_drift(ref, cur, NUM).select("feature", "mean_shift")


@register("category_shares", rnd(shares_sql(), ["share_ref", "share_cur"]))
def category_shares(spark, sf):
    """A16 + J3: aligned category shares, absent -> 0.001."""
    ref, cur = halves(spark, sf)
    return dr.category_shares(ref, cur, CAT)


@register("drift_psi", rnd(f"SELECT feature, n_categories, psi, psi_over_bound FROM ({cat_sql()}) q",
                           ["psi"]))
def drift_psi(spark, sf):
    """D3 + D9: population stability index and the 0.2 bound flag."""
    ref, cur = halves(spark, sf)
    return dr.categorical_drift(ref, cur, CAT).select("feature", "n_categories", "psi",
                                                      "psi_over_bound")


@register("drift_kl", rnd(f"SELECT feature, kl FROM ({cat_sql()}) q", ["kl"]))
def drift_kl(spark, sf):
    """KL divergence of current from reference shares."""
    ref, cur = halves(spark, sf)
    return dr.categorical_drift(ref, cur, CAT).select("feature", "kl")


@register("drift_features", rnd(features_sql(), ["score"]))
def drift_features(spark, sf):
    """Every shared column, numeric -> W1, categorical -> PSI."""
    ref, cur = halves(spark, sf)
    return dr.feature_drift(ref.drop("pred"), cur.drop("pred"))


@register("drift_overall", rnd(f"""
SELECT avg(score) AS overall_score, avg(score) > 0.1 AS drift_detected,
  coalesce(string_agg(CASE WHEN drifted THEN feature END, ',' ORDER BY CASE WHEN drifted THEN feature END), '')
    AS drifted_features, count(*)::BIGINT AS n_features
FROM ({features_sql()}) f""", ["overall_score"]))
def drift_overall(spark, sf):
    """Mean drift over features, detected flag, drifted list."""
    ref, cur = halves(spark, sf)
    return dr.overall_drift(dr.feature_drift(ref.drop("pred"), cur.drop("pred")))


@register("prediction_drift", rnd(f"""
SELECT wasserstein AS drift_score, wasserstein > 0.1 AS drift_detected, 0.1::DOUBLE AS threshold
FROM ({num_sql(['pred'])}) q""", ["drift_score", "threshold"]))
def prediction_drift(spark, sf):
    """Drift of a numeric prediction column."""
    ref, cur = halves(spark, sf)
    return dr.prediction_drift(ref, cur, "pred")


@register("drift_alerts", rnd(f"""
SELECT TIMESTAMP '2024-01-31 00:00:00' AS ts, 'data_drift' AS drift_type, feature AS metric,
  score AS current_value, 0.0::DOUBLE AS baseline_value, 0.1::DOUBLE AS threshold, 'medium' AS severity,
  printf('Data drift in %s: %.4f > %.2f', feature, score, 0.1) AS message
FROM ({features_sql()}) f WHERE drifted""", ["current_value", "baseline_value", "threshold"]))
def drift_alerts(spark, sf):
    """T2 (data drift part): medium alert per drifted feature."""
    ref, cur = halves(spark, sf)
    return dr.drift_alerts(dr.feature_drift(ref.drop("pred"), cur.drop("pred")),
                           datetime(2024, 1, 31))


@register("reference_profile", f"""
SELECT feature, 'numeric' AS kind, v AS v_num, NULL::VARCHAR AS v_str, count(*)::BIGINT AS n FROM (
  SELECT 'value' AS feature, value AS v FROM {REF_SQL} r
  UNION ALL SELECT 'user_id', user_id FROM {REF_SQL} r2) a WHERE v IS NOT NULL AND NOT isnan(v)
GROUP BY feature, v
UNION ALL
SELECT 'event_type', 'categorical', NULL::DOUBLE, event_type, count(*)::BIGINT FROM {REF_SQL} r3
WHERE event_type IS NOT NULL GROUP BY event_type""")
def reference_profile(spark, sf):
    """The reference kept as a histogram, not raw rows."""
    ref, _ = halves(spark, sf)
    return dr.reference_profile(ref, ["value", "user_id"], ["event_type"])
