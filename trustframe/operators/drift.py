"""Distribution drift between a reference and a current table.

Both sides are reduced to value histograms first: numeric columns to
(feature, value, cnt_ref, cnt_cur), categorical columns to
(feature, category, cnt_ref, cnt_cur). The histograms are the materialisable
reference profile (D6). Wasserstein-1 and Kolmogorov-Smirnov need cumulative
counts over sorted values; those come from ``prefix_counts`` (H1), which sums
inside quantile buckets rather than over one window per feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustframe.functions.exprs import nan_to_null
from trustframe.operators.ranking import prefix_counts
from trustframe.session import cut_lineage

# Drift thresholds and the share used for an absent category.
DATA_DRIFT = 0.1
PREDICTION_DRIFT = 0.1
PSI_BOUND = 0.2
ABSENT_SHARE = 0.001


def _long(df: DataFrame, cols: Sequence[str], side: int, numeric: bool) -> DataFrame:
    tags = F.array(*[F.struct(
        F.lit(c).alias("feature"),
        (nan_to_null(F.col(c).cast("double")) if numeric else F.col(c).cast("string")).alias("v"))
        for c in cols])
    return df.select(F.inline(tags)).where(F.col("v").isNotNull()) \
        .withColumn("side", F.lit(side))


def histogram(ref: DataFrame, cur: DataFrame, cols: Sequence[str], numeric: bool) -> DataFrame:
    """(feature, v, cnt_ref, cnt_cur) over the union of values (one shuffle,
    map-side partial counts)."""
    u = _long(ref, cols, 0, numeric).unionByName(_long(cur, cols, 1, numeric))
    return u.groupBy("feature", "v").agg(F.count_if(F.col("side") == 0).alias("cnt_ref"),
                                         F.count_if(F.col("side") == 1).alias("cnt_cur"))


def numeric_drift(ref: DataFrame, cur: DataFrame, cols: Sequence[str],
                  rows_per_bucket: int = 100_000) -> DataFrame:
    """Per feature: n_ref, n_cur, lo, hi (joint range, A10), wasserstein (W1 of
    the joint min-max scaled samples; 0 when a side is empty or the range is
    0), ks (max CDF gap), mean_shift (|mean_ref - mean_cur| / sample std of
    the reference)."""
    h = cut_lineage(histogram(ref, cur, cols, True))  # read by several jobs; scan once
    return _numeric_from_hist(h, rows_per_bucket)


def _numeric_from_hist(h: DataFrame, rows_per_bucket: int = 100_000) -> DataFrame:
    """Numeric drift statistics from a materialised (feature, v, cnt_ref,
    cnt_cur) histogram."""
    tot = h.groupBy("feature").agg(
        F.sum("cnt_ref").alias("n_ref"), F.sum("cnt_cur").alias("n_cur"),
        F.min("v").alias("lo"), F.max("v").alias("hi"),
        F.try_divide(F.sum(F.col("v") * F.col("cnt_ref")), F.sum("cnt_ref")).alias("mean_ref"),
        F.try_divide(F.sum(F.col("v") * F.col("cnt_cur")), F.sum("cnt_cur")).alias("mean_cur"))
    cum = prefix_counts(h, "feature", "v", ["cnt_ref", "cnt_cur"], rows_per_bucket,
                        materialized=True)
    j = cum.join(F.broadcast(tot), "feature")  # one row per feature
    gap = F.abs(F.try_divide(F.col("cum_cnt_ref"), F.col("n_ref"))
                - F.try_divide(F.col("cum_cnt_cur"), F.col("n_cur")))
    step = F.coalesce(F.col("next_value") - F.col("v"), F.lit(0.0))
    per = j.groupBy("feature").agg(
        F.sum(gap * step).alias("area"), F.max(gap).alias("ks"),
        F.sum(F.col("cnt_ref") * (F.col("v") - F.col("mean_ref")) ** 2).alias("ss_ref"))
    out = tot.join(per, "feature")
    rng = F.col("hi") - F.col("lo")
    empty = (F.col("n_ref") == 0) | (F.col("n_cur") == 0)
    return out.select(
        "feature", "n_ref", "n_cur", "lo", "hi",
        F.when(empty | (rng == 0), F.lit(0.0)).otherwise(F.col("area") / rng).alias("wasserstein"),
        F.when(empty, F.lit(0.0)).otherwise(F.col("ks")).alias("ks"),
        F.try_divide(F.abs(F.col("mean_ref") - F.col("mean_cur")),
                     F.sqrt(F.try_divide(F.col("ss_ref"), F.col("n_ref") - 1))).alias("mean_shift"))


def category_shares(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A16 + J3: per (feature, category) the normalised share on each side;
    a category missing on one side gets share 0.001 there (not renormalised)."""
    h = cut_lineage(histogram(ref, cur, cols, False))  # compact; read twice
    return _shares_from_hist(h)


def _shares_from_hist(h: DataFrame) -> DataFrame:
    tot = h.groupBy("feature").agg(F.sum("cnt_ref").alias("n_ref"),
                                   F.sum("cnt_cur").alias("n_cur"))
    j = h.join(F.broadcast(tot), "feature")  # one row per feature
    share = lambda c, n: F.when(F.col(c) > 0, F.col(c) / F.col(n)).otherwise(F.lit(ABSENT_SHARE))  # noqa
    return j.select("feature", F.col("v").alias("category"), "cnt_ref", "cnt_cur",
                    share("cnt_ref", "n_ref").alias("share_ref"),
                    share("cnt_cur", "n_cur").alias("share_cur"))


def categorical_drift(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per feature: psi = |sum (c - r) ln(c / r)|, kl = sum c ln(c / r),
    psi_over_bound (PSI > 0.2; declared bound, reported only)."""
    return _categorical_from_shares(category_shares(ref, cur, cols))


def _categorical_from_shares(s: DataFrame) -> DataFrame:
    r, c = F.col("share_ref"), F.col("share_cur")
    agg = s.groupBy("feature").agg(F.sum((c - r) * F.log(c / r)).alias("psi_raw"),
                                   F.sum(c * F.log(c / r)).alias("kl"),
                                   F.count(F.lit(1)).alias("n_categories"))
    return agg.select("feature", "n_categories", F.abs("psi_raw").alias("psi"), "kl",
                      (F.abs("psi_raw") > PSI_BOUND).alias("psi_over_bound"))


def mixed_histogram(ref: DataFrame, cur: DataFrame, numeric: Sequence[str],
                    categorical: Sequence[str]) -> DataFrame:
    """One histogram for numeric and categorical columns together:
    (feature, kind, v_num, v_str, cnt_ref, cnt_cur); each side is scanned
    once by one generator."""
    def tag(df, side):
        t = [F.struct(F.lit(c).alias("feature"), F.lit("numeric").alias("kind"),
                      nan_to_null(F.col(c).cast("double")).alias("v_num"),
                      F.lit(None).cast("string").alias("v_str")) for c in numeric]
        t += [F.struct(F.lit(c).alias("feature"), F.lit("categorical").alias("kind"),
                       F.lit(None).cast("double").alias("v_num"),
                       F.col(c).cast("string").alias("v_str")) for c in categorical]
        return df.select(F.inline(F.array(*t))) \
            .where(F.col("v_num").isNotNull() | F.col("v_str").isNotNull()) \
            .withColumn("side", F.lit(side))
    u = tag(ref, 0).unionByName(tag(cur, 1))
    return u.groupBy("feature", "kind", "v_num", "v_str").agg(
        F.count_if(F.col("side") == 0).alias("cnt_ref"), F.count_if(F.col("side") == 1).alias("cnt_cur"))


def feature_drift(ref: DataFrame, cur: DataFrame, threshold: float = DATA_DRIFT) -> DataFrame:
    """Every column present in both tables; numeric -> Wasserstein,
    other -> PSI. Output: feature, method, score, drifted. Both kinds share
    one materialised histogram, so each table is scanned once."""
    shared = [c for c in ref.columns if c in cur.columns]  # P11
    num = [c for c in shared if ref.schema[c].dataType.typeName() in
           ("double", "float", "integer", "long", "short", "byte", "decimal")]
    cat = [c for c in shared if c not in num]  # dates, times, flags and nested values as text
    return _drift_from_mixed(cut_lineage(mixed_histogram(ref, cur, num, cat)), threshold)


def _drift_from_mixed(h: DataFrame, threshold: float) -> DataFrame:
    """feature, method, score, drifted from a materialised mixed histogram."""
    hn = h.where(F.col("kind") == "numeric").select("feature", F.col("v_num").alias("v"), "cnt_ref", "cnt_cur")
    hc = h.where(F.col("kind") == "categorical").select("feature", F.col("v_str").alias("v"), "cnt_ref", "cnt_cur")
    out = _numeric_from_hist(hn).select(
        "feature", F.lit("wasserstein").alias("method"), F.col("wasserstein").alias("score"))
    out = out.unionByName(_categorical_from_shares(_shares_from_hist(hc)).select(
        "feature", F.lit("psi").alias("method"), F.col("psi").alias("score")))
    return out.withColumn("drifted", F.col("score") > F.lit(threshold))


def drift_from_profile(profile: DataFrame, cur: DataFrame, threshold: float = DATA_DRIFT) -> DataFrame:
    """D4 against a stored reference profile (D6): the batch is reduced to its own
    histogram and added to the profile's; no reference rows are read. Features of
    the profile that the batch lacks are left out (P11)."""
    kinds = {r["feature"]: r["kind"] for r in profile.select("feature", "kind").distinct().collect()}  # one per feature
    num = [c for c in cur.columns if kinds.get(c) == "numeric"]
    cat = [c for c in cur.columns if kinds.get(c) == "categorical"]
    mine = reference_profile(cur, num, cat)
    keys = ["feature", "kind", "v_num", "v_str"]
    both = profile.where(F.col("feature").isin(num + cat)).select(*keys, F.col("n").alias("cnt_ref"), F.lit(0).cast("long").alias("cnt_cur")) \
        .unionByName(mine.select(*keys, F.lit(0).cast("long").alias("cnt_ref"), F.col("n").alias("cnt_cur")))
    h = both.groupBy(*keys).agg(F.sum("cnt_ref").alias("cnt_ref"), F.sum("cnt_cur").alias("cnt_cur"))
    return _drift_from_mixed(cut_lineage(h), threshold)


def overall_drift(per_feature: DataFrame, threshold: float = DATA_DRIFT) -> DataFrame:
    """Mean score over features, detected flag, sorted drifted list."""
    return per_feature.agg(
        F.avg("score").alias("overall_score"),
        (F.avg("score") > F.lit(threshold)).alias("drift_detected"),
        F.concat_ws(",", F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature")))))
        .alias("drifted_features"),
        F.count(F.lit(1)).alias("n_features"))


def prediction_drift(ref: DataFrame | None, cur: DataFrame, col: str,
                     threshold: float = PREDICTION_DRIFT) -> DataFrame:
    """Drift of the prediction column; without a reference: not detected, 0."""
    spark = cur.sparkSession
    if ref is None:
        return spark.createDataFrame([(0.0, False, float(threshold))],
                                     "drift_score double, drift_detected boolean, threshold double")
    numeric = cur.schema[col].dataType.typeName() not in ("string", "boolean")
    if numeric:
        s = numeric_drift(ref.select(col), cur.select(col), [col]) \
            .select(F.col("wasserstein").alias("drift_score"))
    else:
        s = categorical_drift(ref.select(col), cur.select(col), [col]) \
            .select(F.col("psi").alias("drift_score"))
    return s.select("drift_score", (F.col("drift_score") > F.lit(threshold)).alias("drift_detected"),
                    F.lit(float(threshold)).alias("threshold"))


def reference_profile(ref: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
                      ) -> DataFrame:
    """The reference kept as a histogram (feature, kind, v_num, v_str, n)
    instead of raw rows; write it once, compare many batches against it.
    One scan: numeric and categorical columns are tagged by one generator."""
    long = tagged_values(ref, numeric, categorical)
    return long.groupBy("feature", "kind", "v_num", "v_str").agg(F.count(F.lit(1)).alias("n"))


def tagged_values(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per value that is not missing: ``keep``, feature, kind, v_num, v_str."""
    tags = [F.struct(F.lit(c).alias("feature"), F.lit("numeric").alias("kind"),
                     nan_to_null(F.col(c).cast("double")).alias("v_num"),
                     F.lit(None).cast("string").alias("v_str")) for c in numeric]
    tags += [F.struct(F.lit(c).alias("feature"), F.lit("categorical").alias("kind"),
                      F.lit(None).cast("double").alias("v_num"),
                      F.col(c).cast("string").alias("v_str")) for c in categorical]
    return df.select(*keep, F.inline(F.array(*tags))) \
        .where(F.col("v_num").isNotNull() | F.col("v_str").isNotNull())


def windowed_drift(profile: DataFrame, counts: DataFrame, threshold: float = DATA_DRIFT) -> DataFrame:
    """D4 for every window of ``counts`` (window_start, feature, kind, v_num, v_str, n) against one stored
    profile (D6): window_start, feature, method, score, drifted. Values of features the profile lacks are left out.

    The profile's values stand once per window that has the feature, since a value the window lacks counts
    too; window and feature together are the key, so windows are spread like features."""
    key = F.concat(F.unix_micros(F.col("window_start").cast("timestamp")).cast("string"), F.lit(":"), F.col("feature"))
    cur = counts.select("window_start", "feature", "kind", "v_num", "v_str", "n", key.alias("k"))
    wins = cur.select("k", F.col("feature").alias("f")).distinct()
    ref = profile.join(wins, F.col("feature") == F.col("f")).select("k", "kind", "v_num", "v_str", F.col("n").alias("cnt_ref"), F.lit(0).cast("long").alias("cnt_cur"))
    known = profile.select(F.col("feature").alias("f"), F.col("kind").alias("fk")).distinct()
    mine = cur.join(known, (F.col("feature") == F.col("f")) & (F.col("kind") == F.col("fk"))).select(
        "k", "kind", "v_num", "v_str", F.lit(0).cast("long").alias("cnt_ref"), F.col("n").alias("cnt_cur"))
    h = ref.unionByName(mine).groupBy(F.col("k").alias("feature"), "kind", "v_num", "v_str").agg(
        F.sum("cnt_ref").alias("cnt_ref"), F.sum("cnt_cur").alias("cnt_cur"))
    d = _drift_from_mixed(cut_lineage(h), threshold)
    at = F.timestamp_micros(F.substring_index("feature", ":", 1).cast("long")).cast(counts.schema["window_start"].dataType)
    return d.select(at.alias("window_start"), F.expr("substring(feature, instr(feature, ':') + 1)").alias("feature"), "method", "score", "drifted")


def drift_alerts(per_feature: DataFrame, ts, threshold: float = DATA_DRIFT) -> DataFrame:
    """T2 (data part): one medium alert per drifted feature."""
    return per_feature.where(F.col("drifted")).select(
        F.lit(ts).cast("timestamp").alias("ts"), F.lit("data_drift").alias("drift_type"),
        F.col("feature").alias("metric"), F.col("score").alias("current_value"),
        F.lit(0.0).alias("baseline_value"), F.lit(float(threshold)).alias("threshold"),
        F.lit("medium").alias("severity"),
        F.format_string("Data drift in %s: %.4f > %.2f", F.col("feature"), F.col("score"),
                        F.lit(float(threshold))).alias("message"))
