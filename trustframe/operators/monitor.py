"""Monitoring over event time (T1-T15): tumbling and sliding windows of
performance and fairness, drift per window against a reference profile,
alert rules, consecutive-violation runs, degradation against a trailing
mean, trends and summaries as of an explicit time.

Row-level work is one windowed aggregate. Everything after it (lag,
trailing means, runs) runs on the per-window table, which is bounded by the
number of windows, not by the data."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trustframe.functions.exprs import rate, safe_div
from trustframe.functions.joins import combine_rows, materialize_small
from trustframe.operators.drift import ABSENT_SHARE, DATA_DRIFT, PREDICTION_DRIFT, drift_from_profile
from trustframe.session import cut_lineage

# Monitoring rules.
DRIFT_WARNING = 0.2
F1_DROP = 0.05
CONSECUTIVE = 3
TRAILING_WINDOWS = 24
DEGRADATION = 0.05
CORRELATION_ALERT = 0.7
RETENTION_HOURS = 168


def window_metrics(df: DataFrame, ts: str, label: Column, pred: Column, priv: Column,
                   duration: str = "1 hour", slide: str | None = None,
                   spd_bound: float = 0.1, di_bounds=(0.8, 1.25)) -> DataFrame:
    """Per event-time window: n, accuracy, precision, recall, f1, selection
    rate of the privileged / unprivileged group, SPD (unpriv - priv), DI and
    the fairness gate. One aggregate over the rows; ``duration`` is a multiple of
    ``slide``."""
    counts = window_counts(df, ts, label, pred, priv, slide or duration)
    if slide:
        # counts are additive: rows are counted once per step, and the steps' counts
        # are summed into the windows that hold them
        bins = counts.select(F.col("w.start").alias("t"), *COUNTS)
        counts = bins.groupBy(F.window("t", duration, slide).alias("w")).agg(*[F.sum(c).alias(c) for c in COUNTS])
    return counted_metrics(counts, spd_bound, di_bounds)


COUNTS = ("n", "tp", "fp", "tn", "fn", "n_priv", "n_unpriv", "pos_priv", "pos_unpriv")


def window_counts(df: DataFrame, ts: str, label: Column, pred: Column, priv: Column,
                  duration: str) -> DataFrame:
    """Per tumbling window ``w``: the additive counts (batch and stream alike)."""
    y, p, g = label.cast("int"), pred.cast("int"), priv.cast("boolean")
    return df.groupBy(F.window(ts, duration).alias("w")).agg(*count_aggregates(y, p, g))


def count_aggregates(y: Column, p: Column, g: Column) -> list[Column]:
    """The COUNTS of label y, prediction p (0/1) and privileged flag g."""
    return [F.count(F.lit(1)).alias("n"),
            F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn"),
            F.count_if(g).alias("n_priv"), F.count_if(~g).alias("n_unpriv"),
            F.count_if(g & (p == 1)).alias("pos_priv"), F.count_if(~g & (p == 1)).alias("pos_unpriv")]


def counted_metrics(counts: DataFrame, spd_bound: float = 0.1, di_bounds=(0.8, 1.25)) -> DataFrame:
    """Metrics of each window ``w`` from its counts."""
    c = F.col
    prec = rate(c("tp"), c("tp") + c("fp"))
    rec = rate(c("tp"), c("tp") + c("fn"))
    srp = rate(c("pos_priv"), c("n_priv"))
    sru = rate(c("pos_unpriv"), c("n_unpriv"))
    out = counts.select(
        c("w.start").alias("window_start"), c("w.end").alias("window_end"), "n",
        rate(c("tp") + c("tn"), c("n")).alias("accuracy"), prec.alias("precision"),
        rec.alias("recall"), rate(2 * c("tp"), 2 * c("tp") + c("fp") + c("fn")).alias("f1"),
        srp.alias("sr_priv"), sru.alias("sr_unpriv"), (sru - srp).alias("spd"),
        safe_div(sru, srp).alias("di"))
    ok = (F.abs(c("spd")) <= spd_bound) & (c("di") >= di_bounds[0]) & (c("di") <= di_bounds[1])
    return out.withColumn("fairness_pass", F.coalesce(ok, F.lit(False)))


def monitor_batch(cur: DataFrame, profile: DataFrame, label: Column | None, pred: Column, priv: Column,
                  pred_col: str | None = None, reference_f1: float | None = None,
                  data_bound: float = DATA_DRIFT, prediction_bound: float = PREDICTION_DRIFT,
                  spd_bound: float = 0.1, di_bounds=(0.8, 1.25), f1_drop: float = F1_DROP) -> DataFrame:
    """The alerts of one batch against a stored reference profile (D6):
    drift_type, metric, current_value, threshold, severity.

    Data drift per feature and drift of ``pred_col`` (medium) from the profile and
    the batch's own histogram; fairness of ``pred`` between ``priv`` and the others
    (high); F1 against ``label`` below ``reference_f1`` by more than ``f1_drop`` (high).
    The batch is scanned for its histogram and for its counts; reference rows are not
    read. A batch function: streams apply it to each micro-batch."""
    cols = ("drift_type", "metric", "current_value", "threshold", "severity")
    feats = drift_from_profile(profile, cur, data_bound)
    is_pred = F.col("feature") == F.lit(pred_col) if pred_col else F.lit(False)
    bound = F.when(is_pred, F.lit(float(prediction_bound))).otherwise(F.lit(float(data_bound)))
    out = feats.where(F.col("score") > bound).select(
        F.when(is_pred, "prediction_drift").otherwise("data_drift").alias("drift_type"), F.col("feature").alias("metric"),
        F.col("score").alias("current_value"), bound.alias("threshold"), F.lit("medium").alias("severity"))
    y, p, g = (F.lit(0) if label is None else label.cast("int")), pred.cast("int"), priv.cast("boolean")
    counts = cur.agg(*count_aggregates(y, p, g)).withColumn("w", F.struct(F.lit(None).alias("start"), F.lit(None).alias("end")))
    m = cut_lineage(counted_metrics(counts, spd_bound, di_bounds), large=False)  # one row
    out = out.unionByName(m.where(~F.col("fairness_pass")).select(
        F.lit("fairness").alias(cols[0]), F.lit("statistical_parity_difference").alias(cols[1]), F.col("spd").alias(cols[2]),
        F.lit(float(spd_bound)).alias(cols[3]), F.lit("high").alias(cols[4])))
    if label is not None and reference_f1 is not None:
        least = float(reference_f1) - f1_drop
        out = out.unionByName(m.where(F.col("f1") < least).select(
            F.lit("performance").alias(cols[0]), F.lit("f1").alias(cols[1]), F.col("f1").alias(cols[2]),
            F.lit(least).alias(cols[3]), F.lit("high").alias(cols[4])))
    return out


def drift_by_window(cur: DataFrame, ref: DataFrame, ts: str, col: str,
                    duration: str = "1 hour") -> DataFrame:
    """PSI of a categorical column per window against the reference shares
    (a category absent on one side counts with share 0.001 there).

    Categories of the reference that a window lacks contribute
    (0.001 - r) ln(0.001 / r) each; that sum is a per-reference constant minus
    the terms of the categories the window does have, so each window needs
    only its own categories joined with the reference (no window x category
    grid, nothing collected)."""
    eps = F.lit(ABSENT_SHARE)
    rc = ref.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("cat")) \
        .agg(F.count(F.lit(1)).alias("c"))
    rc = cut_lineage(rc)
    total = rc.agg(F.sum("c")).first()[0] or 1  # one scalar; the category table itself can be as long as a wide column
    # per reference category: share and its "absent from the window" term
    rs = rc.select("cat", (F.col("c") / F.lit(total)).alias("share_ref"))
    rs = rs.withColumn("absent_term", (eps - F.col("share_ref")) * F.log(eps / F.col("share_ref")))
    rs, small = materialize_small(rs)
    t_ref = rs.agg(F.sum("absent_term")).first()[0] or 0.0  # one scalar
    wc = cur.where(F.col(col).isNotNull()).groupBy(
        F.window(ts, duration).start.alias("window_start"),
        F.col(col).cast("string").alias("cat")).agg(F.count(F.lit(1)).alias("c"))
    tot = Window.partitionBy("window_start")  # one window's categories
    j = wc.join(F.broadcast(rs) if small else rs, "cat", "left")
    share_cur = F.col("c") / F.sum("c").over(tot)
    r = F.coalesce(F.col("share_ref"), eps)
    j = j.select("window_start", share_cur.alias("sc"), r.alias("r"), "absent_term")
    agg = j.groupBy("window_start").agg(
        F.sum((F.col("sc") - F.col("r")) * F.log(F.col("sc") / F.col("r"))).alias("present"),
        F.sum(F.coalesce(F.col("absent_term"), F.lit(0.0))).alias("covered"))
    return agg.select("window_start",
                      F.abs(F.col("present") + F.lit(float(t_ref)) - F.col("covered")).alias("psi"))


def consecutive_runs(windows: DataFrame, order: str, fail: Column, k: int = CONSECUTIVE,
                     by: Sequence[str] = ()) -> DataFrame:
    """T11 (batch): gaps and islands over the ordered window table; one alert
    row where a run of failures reaches length k (F F P F F F -> one alert,
    at the sixth)."""
    w_all = Window.partitionBy(*by).orderBy(order)
    t = windows.withColumn("__fail", fail).withColumn("__rn", F.row_number().over(w_all))
    w_flag = Window.partitionBy(*by, "__fail").orderBy(order)
    t = t.withColumn("__island", F.col("__rn") - F.row_number().over(w_flag))
    w_run = Window.partitionBy(*by, "__fail", "__island").orderBy(order)
    t = t.withColumn("run_length", F.row_number().over(w_run))
    return t.where(F.col("__fail") & (F.col("run_length") == k)).drop("__fail", "__rn", "__island")


def degradation(windows: DataFrame, order: str, metric: str, lookback: int = TRAILING_WINDOWS,
                drop: float = DEGRADATION, seconds: int = 3600) -> DataFrame:
    """Metric against its mean over the ``lookback`` windows of ``seconds``
    before; degraded when the relative drop exceeds ``drop``. The frame is one of
    time: windows without rows don't stretch it further back."""
    w = Window.orderBy(F.unix_seconds(F.col(order).cast("timestamp"))).rangeBetween(-lookback * seconds, -1)  # per-window table only
    tr = f"trailing_{metric}"
    t = windows.select(order, metric, F.avg(metric).over(w).alias(tr))
    return t.withColumn("degraded", F.coalesce(
        (F.col(tr) > 0) & ((F.col(tr) - F.col(metric)) / F.col(tr) > drop), F.lit(False)))


def alert_rules(windows: DataFrame, drift: DataFrame) -> DataFrame:
    """T7 + T8 + W2: drift > 0.2 warning; fairness gate failed critical; F1
    drop against the previous window > 0.05 warning. Output: ts, rule,
    severity, value."""
    j = windows.join(drift, "window_start", "left")
    prev = F.lag("f1").over(Window.orderBy("window_start"))  # per-window table only
    j = j.withColumn("f1_delta", F.col("f1") - prev)
    rules = F.array(
        F.when(F.col("psi") > DRIFT_WARNING,
               F.struct(F.lit("drift").alias("rule"), F.lit("warning").alias("severity"),
                        F.col("psi").alias("value"))),
        F.when(~F.col("fairness_pass"),
               F.struct(F.lit("fairness").alias("rule"), F.lit("critical").alias("severity"),
                        F.col("spd").alias("value"))),
        F.when(F.col("f1_delta") < -F1_DROP,
               F.struct(F.lit("f1_drop").alias("rule"), F.lit("warning").alias("severity"),
                        F.col("f1_delta").alias("value"))))
    return j.select(F.col("window_start").alias("ts"), F.explode(F.filter(rules, lambda x: x.isNotNull()))
                    .alias("a")).select("ts", "a.rule", "a.severity", "a.value")


def recent(df: DataFrame, ts: str, as_of: datetime, hours: int) -> DataFrame:
    """Rows with as_of - hours < ts <= as_of (as_of is a parameter)."""
    hi = F.lit(as_of).cast("timestamp")
    return df.where((F.col(ts) > hi - F.expr(f"INTERVAL {int(hours)} HOURS")) & (F.col(ts) <= hi))


def summary(windows: DataFrame, drift: DataFrame, alerts: DataFrame, as_of: datetime,
            hours: int = RETENTION_HOURS) -> DataFrame:
    """T5 + A18 + A19: one row of means and alert counts per rule in the last
    ``hours`` before ``as_of``."""
    w = recent(windows.join(drift, "window_start", "left"), "window_start", as_of, hours)
    a = recent(alerts, "ts", as_of, hours)
    m = w.agg(F.count(F.lit(1)).alias("n_windows"), F.avg("accuracy").alias("mean_accuracy"),
              F.avg("f1").alias("mean_f1"), F.avg("psi").alias("mean_drift"),
              F.avg(F.col("fairness_pass").cast("double")).alias("fairness_pass_rate"))
    c = a.agg(*[F.count_if(F.col("rule") == r).alias(f"n_{r}_alerts")
                for r in ("drift", "fairness", "f1_drop")])
    return combine_rows(m, c)  # one-row aggregates side by side


def served_metrics(log: DataFrame, ts: str, violation: Column, latency: str,
                   buckets: Sequence[float] = (5.0, 10.0, 25.0, 50.0, 100.0)) -> DataFrame:
    """Per day predictions, violations, mean latency and a cumulative
    latency histogram (``le_<b>`` counts)."""
    cols = [F.count_if(F.col(latency) <= b).alias(f"le_{int(b)}") for b in buckets]
    return log.groupBy(F.date_format(ts, "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("n_predictions"), F.count_if(violation).alias("n_violations"),
        F.avg(latency).alias("mean_latency"), *cols)


#: size parameter of the sketches and their rank error (as a share of the rows) at 99 % confidence
SKETCH_K, SKETCH_ERROR = 200, 0.0165


def latency_sketches(log: DataFrame, ts: str, latency: str, by: Sequence[str] = ()) -> DataFrame:
    """Per hour (and ``by``) a mergeable quantile sketch (KLL) of the latencies: hour, n, sketch. One aggregate with
    partial sketches before the shuffle; a row per hour is stored, whatever the traffic. Missing latencies count nowhere."""
    v = F.col(latency).cast("double")
    rows = log.where(v.isNotNull() & ~F.isnan(v)).withColumn("__v", v)
    return rows.groupBy(F.date_trunc("hour", ts).alias("hour"), *by).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("__v", F.lit(SKETCH_K)).alias("sketch"))


def latency_percentiles(sketches: DataFrame, quantiles: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Stored hourly sketches merged by day: day, ``by``, n, q, estimate. The rank of an estimate is within
    ``SKETCH_ERROR`` of q; no row of the log is read again."""
    d = sketches.groupBy(F.date_format("hour", "yyyy-MM-dd").alias("day"), *by).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(SKETCH_K)).alias("sketch"))
    q = F.explode(F.array(*[F.struct(F.lit(float(x)).alias("q"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(x))).alias("estimate"))
                            for x in quantiles])).alias("x")
    return d.select("day", *by, "n", q).select("day", *by, "n", "x.q", "x.estimate")
