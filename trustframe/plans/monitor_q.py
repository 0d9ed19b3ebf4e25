"""Monitoring queries on events (T1-T15, P13, A18, A19, W2, W3): label
event_type = 'purchase', prediction value > 30, privileged group user_id
even; reference for drift = events before 2024-01-16."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from trustframe.operators import drift as dr
from trustframe.operators import monitor as mo
from trustframe.plans import drift_q
from trustframe.plans.registry import T, register, rnd
from trustframe.session import cut_lineage, ensure_checkpoint_dir

def LABEL():
    return F.col("event_type") == "purchase"


def PRED():
    return F.col("value") > 30.0


def PRIV():
    return F.col("user_id") % 2 == 0


AS_OF = datetime(2024, 1, 31)
CUT = drift_q.CUT

_WCOLS = ["accuracy", "precision", "recall", "f1", "sr_priv", "sr_unpriv", "spd", "di"]


def _win_sql(start: str, end: str, src: str = "events") -> str:
    return f"""
SELECT window_start, window_end, n, accuracy, precision, recall, f1, sr_priv, sr_unpriv,
  sr_unpriv - sr_priv AS spd,
  CASE WHEN sr_priv IS NOT NULL AND sr_priv <> 0 THEN sr_unpriv / sr_priv ELSE 0.0 END AS di,
  coalesce(abs(sr_unpriv - sr_priv) <= 0.1 AND
           (CASE WHEN sr_priv <> 0 THEN sr_unpriv / sr_priv ELSE 0.0 END) BETWEEN 0.8 AND 1.25, false)
    AS fairness_pass
FROM (SELECT window_start, window_end, n,
  CASE WHEN n > 0 THEN (tp + tn)::DOUBLE / n ELSE 0.0 END AS accuracy,
  CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0.0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN (2 * tp)::DOUBLE / (2 * tp + fp + fn) ELSE 0.0 END AS f1,
  CASE WHEN n_priv > 0 THEN pos_priv::DOUBLE / n_priv ELSE 0.0 END AS sr_priv,
  CASE WHEN n_unpriv > 0 THEN pos_unpriv::DOUBLE / n_unpriv ELSE 0.0 END AS sr_unpriv
FROM (SELECT {start} AS window_start, {end} AS window_end, count(*)::BIGINT AS n,
        count_if(y = 1 AND p = 1) AS tp, count_if(y = 0 AND p = 1) AS fp,
        count_if(y = 0 AND p = 0) AS tn, count_if(y = 1 AND p = 0) AS fn,
        count_if(g) AS n_priv, count_if(NOT g) AS n_unpriv,
        count_if(g AND p = 1) AS pos_priv, count_if(NOT g AND p = 1) AS pos_unpriv
      FROM (SELECT *, CAST(event_type = 'purchase' AS INTEGER) AS y, CAST(value > 30.0 AS INTEGER) AS p,
              user_id % 2 = 0 AS g FROM {src} e) t
      GROUP BY 1, 2) a) b"""


HOURLY_SQL = _win_sql("date_trunc('hour', ts)", "date_trunc('hour', ts) + INTERVAL 1 HOUR")
SLIDING_SQL = _win_sql("ws", "ws + INTERVAL 24 HOUR",
                       "(SELECT *, date_trunc('hour', ts) - k * INTERVAL 1 HOUR AS ws "
                       "FROM events, range(0, 24) r(k))")

DRIFT_SQL = f"""
WITH rs AS (SELECT event_type AS cat, count(*) / sum(count(*)) OVER () AS share_ref FROM events
            WHERE ts < TIMESTAMP '{CUT}' AND event_type IS NOT NULL GROUP BY 1),
wc AS (SELECT date_trunc('hour', ts) AS window_start, event_type AS cat, count(*) AS c FROM events
       WHERE event_type IS NOT NULL GROUP BY 1, 2),
grid AS (SELECT w.window_start, rs.cat FROM (SELECT DISTINCT window_start FROM wc) w, rs),
cells AS (SELECT coalesce(g.window_start, wc.window_start) AS window_start, coalesce(g.cat, wc.cat) AS cat,
            coalesce(wc.c, 0) AS c FROM grid g FULL OUTER JOIN wc
            ON g.window_start = wc.window_start AND g.cat = wc.cat),
s AS (SELECT window_start, cat, CASE WHEN c > 0 THEN c / sum(c) OVER (PARTITION BY window_start)
        ELSE 0.001 END AS share_cur FROM cells)
SELECT window_start, abs(sum((share_cur - coalesce(rs.share_ref, 0.001))
                         * ln(share_cur / coalesce(rs.share_ref, 0.001)))) AS psi
FROM s LEFT JOIN rs USING (cat) GROUP BY window_start"""

ALERTS_SQL = f"""
WITH w AS ({HOURLY_SQL}), d AS ({DRIFT_SQL}),
j AS (SELECT w.*, d.psi, f1 - lag(f1) OVER (ORDER BY w.window_start) AS f1_delta
      FROM w LEFT JOIN d USING (window_start))
SELECT window_start AS ts, 'drift' AS rule, 'warning' AS severity, psi AS value FROM j WHERE psi > 0.2
UNION ALL SELECT window_start, 'fairness', 'critical', spd FROM j WHERE NOT fairness_pass
UNION ALL SELECT window_start, 'f1_drop', 'warning', f1_delta FROM j WHERE f1_delta < -0.05"""


def hourly(spark, sf):
    return mo.window_metrics(T(spark, sf, "events"), "ts", LABEL(), PRED(), PRIV(), "1 hour")


def drift_windows(spark, sf):
    ev = T(spark, sf, "events")
    ref = ev.where(F.col("ts") < F.lit(CUT).cast("timestamp"))
    return mo.drift_by_window(ev, ref, "ts", "event_type", "1 hour")


def alerts(spark, sf):
    return mo.alert_rules(hourly(spark, sf), drift_windows(spark, sf))


@register("monitor_hourly", rnd(HOURLY_SQL, _WCOLS))
def monitor_hourly(spark, sf):
    """Hourly tumbling windows of performance and fairness."""
    return hourly(spark, sf)


@register("monitor_sliding", rnd(SLIDING_SQL, _WCOLS))
def monitor_sliding(spark, sf):
    """T10 + W3: 24-hour windows sliding by one hour."""
    return mo.window_metrics(T(spark, sf, "events"), "ts", LABEL(), PRED(), PRIV(), "24 hours", "1 hour")


@register("drift_by_window", rnd(DRIFT_SQL, ["psi"]))
def drift_by_window(spark, sf):
    """T1 (drift part) per hour: PSI of event_type against the reference."""
    return drift_windows(spark, sf)


CONSEC_SQL = rnd(f"""
WITH w AS ({HOURLY_SQL}),
t AS (SELECT *, NOT fairness_pass AS fail, row_number() OVER (ORDER BY window_start) AS rn FROM w),
u AS (SELECT *, rn - row_number() OVER (PARTITION BY fail ORDER BY window_start) AS island FROM t),
v AS (SELECT *, row_number() OVER (PARTITION BY fail, island ORDER BY window_start) AS run_length FROM u)
SELECT window_start, window_end, n, accuracy, precision, recall, f1, sr_priv, sr_unpriv, spd, di,
  fairness_pass, CAST(run_length AS INTEGER) AS run_length FROM v WHERE fail AND run_length = 3""", _WCOLS)


@register("consecutive_violations", CONSEC_SQL)
def consecutive_violations(spark, sf):
    """An alert where 3 consecutive hourly fairness checks fail."""
    w = hourly(spark, sf)
    return mo.consecutive_runs(w, "window_start", ~F.col("fairness_pass"), 3)


@register("degradation", rnd(f"""
WITH w AS ({HOURLY_SQL})
SELECT window_start, f1, trailing_f1,
  coalesce(trailing_f1 > 0 AND (trailing_f1 - f1) / trailing_f1 > 0.05, false) AS degraded FROM (
  SELECT window_start, f1, avg(f1) OVER (ORDER BY window_start RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 SECOND PRECEDING)
    AS trailing_f1 FROM w) x""", ["f1", "trailing_f1"]))
def degradation(spark, sf):
    """F1 against its mean over the 24 hours before (5 % relative drop)."""
    return mo.degradation(hourly(spark, sf), "window_start", "f1")


@register("alert_rules", rnd(ALERTS_SQL, ["value"]))
def alert_rules(spark, sf):
    """T7 + T8 + W2: rule table over hourly windows."""
    return alerts(spark, sf)


@register("alerts_latest", rnd(f"""
SELECT * FROM ({ALERTS_SQL}) a ORDER BY ts DESC, rule LIMIT 10""", ["value"]))
def alerts_latest(spark, sf):
    """Latest 10 alerts (the limit is the feature)."""
    return alerts(spark, sf).orderBy(F.col("ts").desc(), "rule").limit(10)


@register("monitor_summary", rnd(f"""
WITH w AS (SELECT w.*, d.psi FROM ({HOURLY_SQL}) w LEFT JOIN ({DRIFT_SQL}) d USING (window_start)
           WHERE window_start > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 168 HOUR
             AND window_start <= TIMESTAMP '2024-01-31 00:00:00'),
a AS (SELECT * FROM ({ALERTS_SQL}) x WHERE ts > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 168 HOUR
             AND ts <= TIMESTAMP '2024-01-31 00:00:00')
SELECT (SELECT count(*) FROM w)::BIGINT AS n_windows, (SELECT avg(accuracy) FROM w) AS mean_accuracy,
  (SELECT avg(f1) FROM w) AS mean_f1, (SELECT avg(psi) FROM w) AS mean_drift,
  (SELECT avg(CAST(fairness_pass AS DOUBLE)) FROM w) AS fairness_pass_rate,
  (SELECT count_if(rule = 'drift') FROM a)::BIGINT AS n_drift_alerts,
  (SELECT count_if(rule = 'fairness') FROM a)::BIGINT AS n_fairness_alerts,
  (SELECT count_if(rule = 'f1_drop') FROM a)::BIGINT AS n_f1_drop_alerts""",
    ["mean_accuracy", "mean_f1", "mean_drift", "fairness_pass_rate"]))
def monitor_summary(spark, sf):
    """T5 + T14 + A18 + A19: last 168 hours before a given as-of time."""
    w = cut_lineage(hourly(spark, sf), large=False)         # per-window tables (compact),
    d = cut_lineage(drift_windows(spark, sf), large=False)  # each read three times
    return mo.summary(w, d, mo.alert_rules(w, d), AS_OF, 168)


@register("monitor_trends", rnd(f"""
SELECT window_start, spd, di, fairness_pass FROM ({HOURLY_SQL}) w
WHERE window_start > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 48 HOUR
  AND window_start <= TIMESTAMP '2024-01-31 00:00:00'""", ["spd", "di"]))
def monitor_trends(spark, sf):
    """T4 + P13: fairness trend series over the last 48 hours."""
    w = mo.recent(hourly(spark, sf), "window_start", AS_OF, 48)
    return w.select("window_start", "spd", "di", "fairness_pass")


@register("drift_fairness_corr", rnd(f"""
SELECT corr(d.psi, abs(w.spd)) AS corr, coalesce(corr(d.psi, abs(w.spd)) >= 0.7, false) AS correlated,
  count(*)::BIGINT AS n_windows
FROM ({HOURLY_SQL}) w JOIN ({DRIFT_SQL}) d USING (window_start)""", ["corr"]))
def drift_fairness_corr(spark, sf):
    """Correlation between per-window drift and |SPD|."""
    j = hourly(spark, sf).join(drift_windows(spark, sf), "window_start")
    c = F.corr("psi", F.abs(F.col("spd")))
    return j.agg(c.alias("corr"), F.coalesce(c >= mo.CORRELATION_ALERT, F.lit(False)).alias("correlated"),
                 F.count(F.lit(1)).alias("n_windows"))


@register("served_metrics", rnd("""
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*)::BIGINT AS n_predictions,
  count_if(event_type = 'error')::BIGINT AS n_violations, avg(value) AS mean_latency,
  count_if(value <= 5.0)::BIGINT AS le_5, count_if(value <= 10.0)::BIGINT AS le_10,
  count_if(value <= 25.0)::BIGINT AS le_25, count_if(value <= 50.0)::BIGINT AS le_50,
  count_if(value <= 100.0)::BIGINT AS le_100
FROM events GROUP BY 1""", ["mean_latency"]))
def served_metrics(spark, sf):
    """Prediction-log roll-ups (error events as violations, value as latency)."""
    return mo.served_metrics(T(spark, sf, "events"), "ts", F.col("event_type") == "error", "value")


_FAIR_CUR = f"""(SELECT CAST(event_type = 'purchase' AS INTEGER) AS y, CAST(value * 1.5 > 30.0 AS INTEGER) AS p,
  user_id % 2 = 0 AS g FROM events WHERE ts >= TIMESTAMP '{CUT}')"""


@register("monitor_batch", rnd(f"""
WITH f AS (SELECT CASE WHEN count_if(g) > 0 THEN count_if(g AND p = 1)::DOUBLE / count_if(g) ELSE 0.0 END AS sp,
                  CASE WHEN count_if(NOT g) > 0 THEN count_if(NOT g AND p = 1)::DOUBLE / count_if(NOT g)
                       ELSE 0.0 END AS su FROM {_FAIR_CUR} c)
SELECT 'data_drift' AS drift_type, feature AS metric, score AS current_value, 0.1::DOUBLE AS threshold,
  'medium' AS severity FROM ({drift_q.features_sql()}) d WHERE drifted
UNION ALL
SELECT 'prediction_drift', 'pred', wasserstein, 0.1, 'medium' FROM ({drift_q.num_sql(['pred'])}) p
WHERE wasserstein > 0.1
UNION ALL
SELECT 'fairness', 'statistical_parity_difference', su - sp, 0.1, 'high' FROM f
WHERE NOT coalesce(abs(su - sp) <= 0.1 AND (CASE WHEN sp <> 0 THEN su / sp ELSE 0.0 END) BETWEEN 0.8 AND 1.25,
                   false)""", ["current_value", "threshold"]))
def monitor_batch(spark, sf):
    """T1 + T2 + T3: one batch (current half) against the reference: data
    drift and prediction drift alerts (medium), fairness alert (high)."""
    ref, cur = drift_q.halves(spark, sf)
    path = f"{ensure_checkpoint_dir(spark)}/profile-{uuid.uuid4().hex}"
    dr.reference_profile(ref, [*drift_q.NUM, "pred"], drift_q.CAT).write.parquet(path)
    return mo.monitor_batch(cur, spark.read.parquet(path), None, F.col("value_shifted") > 30.0,
                            F.col("user_id").cast("long") % 2 == 0, "pred")
