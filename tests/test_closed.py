"""Hand-computed cases (FIXTURES §4) and properties."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trustframe.functions.exprs import right_closed_bins
from trustframe.functions.joins import materialize_small
from trustframe.operators import clean, drift, encode, explain, fairness as fz, metrics
from trustframe.operators import monitor, ranking, sampling, stats, weights


def test_confusion_empty_positive_group(spark):
    rows = [("a", 1, 1), ("a", 1, 0), ("a", 0, 1), ("a", 0, 0),
            ("b", 0, 0), ("b", 0, 1), ("b", 0, 0), ("b", 0, 0)]
    df = spark.createDataFrame(rows, "g string, y int, p int")
    out = {r.grp: r for r in fz.group_confusion(
        df, [fz.Protected("g", privileged=["a"])], F.col("y") == 1, F.col("p") == 1).collect()}
    assert out["b"].tpr == 0.0 and out["b"].fpr == pytest.approx(0.25)
    assert out["a"].tpr == 0.5 and out["a"].selection_rate == 0.5
    m = fz.parity_metrics(fz.group_confusion(
        df, [fz.Protected("g", privileged=["a"])], F.col("y") == 1, F.col("p") == 1)).first()
    assert m.equal_opportunity_difference == pytest.approx(-0.5)
    assert m.statistical_parity_difference == pytest.approx(0.25 - 0.5)
    assert m.average_odds_difference == pytest.approx(((0 - 0.5) + (0.25 - 0.5)) / 2)


def test_zero_privileged_rate_gives_di_zero_and_fails(spark):
    df = spark.createDataFrame([("a", 0, 0), ("a", 1, 0), ("b", 1, 1), ("b", 0, 1)],
                               "g string, y int, p int")
    m = fz.fairness_metrics(df, [fz.Protected("g", privileged=["a"])], F.col("y") == 1,
                            F.col("p") == 1)
    assert m.first().disparate_impact == 0.0
    g = fz.apply_gates(m, fz.gate_table(spark))
    v = fz.verdict(g).first()
    assert v.overall_pass is False
    assert "disparate_impact" in v.failed_metrics.split(",")


def test_threshold_case_two_violations(spark):
    m = spark.createDataFrame([("x", "*", 0.75, 0.15, 0.05, 0.0, 0.15)],
                              "attr string, unpriv_group string, disparate_impact double, "
                              "statistical_parity_difference double, equal_opportunity_difference "
                              "double, average_odds_difference double, demographic_parity double")
    g = fz.apply_gates(m, fz.gate_table(spark))
    v = fz.verdict(g).first()
    assert v.failed_metrics == "disparate_impact,statistical_parity_difference"
    assert v.n_failed == 2


def test_nan_metric_fails_gate(spark):
    m = spark.createDataFrame([("x", "*", float("nan"), 0.0, 0.0, 0.0, 0.0)],
                              "attr string, unpriv_group string, disparate_impact double, "
                              "statistical_parity_difference double, equal_opportunity_difference "
                              "double, average_odds_difference double, demographic_parity double")
    rows = {r.metric: r["pass"] for r in fz.apply_gates(m, fz.gate_table(spark)).collect()}
    assert rows["disparate_impact"] is False
    assert rows["statistical_parity_difference"] is True


def test_gate_spellings(spark):
    t = {r.metric: (r.lo, r.hi) for r in fz.gate_table(spark, {
        "disparate_impact": {"min": 0.8, "max": 1.25},
        "statistical_parity_difference": {"max_abs": 0.1},
        "equal_opportunity_difference": 0.05}).collect()}
    assert t["disparate_impact"] == (0.8, 1.25)
    assert t["statistical_parity_difference"] == (-0.1, 0.1)
    assert t["equal_opportunity_difference"] == (-0.05, 0.05)


def test_privileged_detection(spark):
    df = spark.createDataFrame([("Male",), ("Female",), ("Female",)], "sex string")
    r = fz.detect_privileged(df, "sex").first()
    assert r.privileged == ["Male"] and r.rule == "male"
    df2 = spark.createDataFrame([("x",), ("y",), ("y",)], "g string")
    r2 = fz.detect_privileged(df2, "g").first()
    assert r2.privileged == ["y"] and r2.rule == "majority"


def test_fairness_invariant_under_repartition(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    args = ([fz.Protected("l_linestatus", privileged=["O"])], F.col("l_returnflag") == "R",
            F.col("l_discount") >= 0.05)
    a = sorted(fz.fairness_metrics(li.repartition(1), *args).collect())
    b = sorted(fz.fairness_metrics(li.repartition(8), *args).collect())
    for x, y in zip(a, b):
        for k in x.asDict():
            if isinstance(x[k], float):
                assert x[k] == pytest.approx(y[k], abs=1e-12)
            else:
                assert x[k] == y[k]


def test_psi_absent_category(spark):
    ref = spark.createDataFrame([("a",), ("b",)], "c string")
    cur = spark.createDataFrame([("a",), ("a",)], "c string")
    r = drift.categorical_drift(ref, cur, ["c"]).first()
    want = abs((1 - 0.5) * math.log(1 / 0.5) + (0.001 - 0.5) * math.log(0.001 / 0.5))
    assert r.psi == pytest.approx(want)
    assert r.psi >= 0


def test_wasserstein_cases(spark):
    ref = spark.createDataFrame([(0.0, 5.0), (1.0, 5.0)], "x double, k double")
    cur = spark.createDataFrame([(1.0, 5.0), (1.0, 5.0)], "x double, k double")
    r = {row.feature: row for row in drift.numeric_drift(ref, cur, ["x", "k"]).collect()}
    assert r["x"].wasserstein == pytest.approx(0.5)
    assert r["x"].ks == pytest.approx(0.5)
    assert r["k"].wasserstein == 0.0  # constant feature
    same = drift.numeric_drift(ref, ref, ["x"]).first()
    assert same.wasserstein == 0.0


def test_wasserstein_many_buckets_matches_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    a, b = rng.normal(0, 1, 3000).round(2), rng.normal(0.3, 1.2, 2000).round(2)
    ref = spark.createDataFrame([(float(x),) for x in a], "x double")
    cur = spark.createDataFrame([(float(x),) for x in b], "x double")
    got = drift.numeric_drift(ref, cur, ["x"], rows_per_bucket=37).first()
    lo, hi = min(a.min(), b.min()), max(a.max(), b.max())
    vals = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), vals, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), vals, side="right") / len(b)
    w1 = float(np.sum(np.abs(fa - fb)[:-1] * np.diff(vals))) / (hi - lo)
    assert got.wasserstein == pytest.approx(w1, rel=1e-9)
    assert got.ks == pytest.approx(float(np.max(np.abs(fa - fb))), rel=1e-9)


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",)], "c string")
    assert stats.column_modes(df, ["c"]).first()["mode"] == "a"


def test_exact_median_matches_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    v = np.concatenate([rng.integers(0, 50, 4001), rng.normal(0, 1, 3000)])
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    got = stats.exact_medians(df, ["x"], accuracy=100).first()["median"]
    assert got == pytest.approx(float(np.median(v)))
    wide = stats.exact_medians(df, ["x"], accuracy=100, narrow_limit=10).first()["median"]
    assert wide == pytest.approx(float(np.median(v)))  # bracket path


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(30.0,), (40.0,), (50.0,), (100.0,), (0.0,), (30.5,)], "a double")
    got = [r.b for r in df.select(right_closed_bins(F.col("a"), clean.AGE_EDGES, clean.AGE_LABELS)
                                  .alias("b")).collect()]
    assert got == ["<30", "30-40", "40-50", "50+", None, "30-40"]


def test_sentinel_and_sparse_rows(spark):
    df = spark.createDataFrame([(" ?", "x", None), ("a", None, None)], "s string, t string, u double")
    out = clean.sentinel_to_null(df, "?").collect()
    assert out[0].s is None and out[1].s == "a"
    kept = clean.drop_sparse_rows(df, 0.7).collect()  # int(0.7*3) = 2 values needed
    assert len(kept) == 1


def test_impute(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (3.0, None), (4.0, "b")], "x double, s string")
    out = clean.impute(df).collect()
    assert out[1].x == 3.0 and out[2].s == "b"


def test_feature_types_boundary(spark):
    rows = [(i % 10, i % 11, float(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "ten int, eleven int, cont double")
    k = {r.feature: r.kind for r in clean.feature_types(df).collect()}
    assert k == {"ten": "categorical", "eleven": "numerical", "cont": "numerical"}


def test_rank_segments_equals_row_number_with_hot_stratum(spark):
    from pyspark.sql.window import Window
    n = 3000
    rows = [(i, "hot" if i % 3 == 0 else f"g{i % 7}") for i in range(n)]
    df = spark.createDataFrame(rows, "id long, g string")
    got = ranking.rank_segments(df, ["g"], "id", 5, lambda N: [ranking.ceil_share(N, 0.2)],
                                ["a", "b"], digits=2)
    w = Window.partitionBy("g").orderBy(F.md5(F.concat(F.lit("5:"), F.col("id").cast("string"))), "id")
    ref = df.withColumn("rn", F.row_number().over(w)).withColumn("n", F.count("*").over(
        Window.partitionBy("g"))).withColumn(
        "segment", F.when(F.col("rn") <= F.ceil(F.col("n") * 0.2), "a").otherwise("b"))
    a = sorted((r.id, r.segment) for r in got.collect())
    b = sorted((r.id, r.segment) for r in ref.collect())
    assert a == b


def test_split_disjoint_exhaustive_and_sized(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    s = sampling.stratified_split(o.select("o_orderkey", "o_orderstatus"), ["o_orderstatus"],
                                  "o_orderkey", 42)
    assert s.count() == o.count()
    assert s.select("o_orderkey").distinct().count() == o.count()
    for r in s.groupBy("o_orderstatus").pivot("split").count().collect():
        n = r.test + r.val + r.train
        assert r.test == math.ceil(n * 0.2 - 1e-9)


def test_composite_fallback_when_stratum_small(spark):
    rows = [(i, i % 2, "en" if i < 95 else "fr") for i in range(100)]
    df = spark.createDataFrame(rows, "id long, y int, lang string")
    _, rule = sampling.composite_strata(df, "y", ["lang"])
    assert rule == "label"
    rows2 = [(i, i % 2, "en" if i < 50 else "fr") for i in range(100)]
    _, rule2 = sampling.composite_strata(spark.createDataFrame(rows2, "id long, y int, lang string"),
                                         "y", ["lang"])
    assert rule2 == "composite"


def test_resample_exact_counts(spark):
    df = spark.createDataFrame([(i, "a" if i < 10 else "b") for i in range(40)], "id long, g string")
    out = sampling.resample_to(df, ["g"], "id", lambda n: F.lit(25).cast("long"))
    c = {r.g: r["count"] for r in out.groupBy("g").count().collect()}
    assert c == {"a": 25, "b": 25}


def test_reweighing_properties(spark):
    rows = [(i, "a" if i % 3 else "b", 1 if i % 4 == 0 else 0) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g string, y int")
    r = weights.reweigh_rows(df, "g", "y")
    assert r.agg(F.sum("weight")).first()[0] == pytest.approx(400.0)
    rates = [x.rate for x in weights.weighted_selection_rates(r, "g", "y", "weight").collect()]
    assert max(rates) - min(rates) == pytest.approx(0.0, abs=1e-12)
    m = weights.reweigh_multi(df.withColumn("h", F.col("id") % 2), ["g", "h"], "y")
    assert m.agg(F.avg("weight")).first()[0] == pytest.approx(1.0)


def test_one_hot_unseen_is_zero_and_population_std(spark):
    tr = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "c string, x double")
    m = encode.fit_encoder(tr, ["x"], ["c"])
    assert m.feature_names() == ["x", "c_b"]
    te = spark.createDataFrame([("z", 2.0)], "c string, x double")
    r = m.transform(te).first()
    assert r["c_b"] == 0.0 and r["x"] == 0.0
    assert m.stds["x"] == pytest.approx(1.0)  # population std of {1, 3}


def test_consecutive_alert_at_sixth(spark):
    t0 = datetime(2024, 1, 1)
    flags = [False, False, True, False, False, False]  # pass flags: F F P F F F
    df = spark.createDataFrame([(t0 + timedelta(hours=i), f) for i, f in enumerate(flags)],
                               "window_start timestamp, fairness_pass boolean")
    out = monitor.consecutive_runs(df, "window_start", ~F.col("fairness_pass"), 3).collect()
    assert len(out) == 1 and out[0].window_start == t0 + timedelta(hours=5)


def test_auc_ties_half(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, s double")
    assert metrics.roc_auc(df, "y", "s").first().auc == pytest.approx(0.875)


def test_sampled_shapley_linear_exact_with_one_background_point(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, -1.0, 0.5)], "id long, a double, b double")
    bg = spark.createDataFrame([(1.0, 1.0)], "a double, b double")

    def lin(c):
        return 2.0 * c["a"] - 3.0 * c["b"]
    out = {(r.id, r.feature): r.shap for r in
           explain.sampled_shapley(df, bg, "id", ["a", "b"], lin, n_perm=4).collect()}
    assert out[(1, "a")] == pytest.approx(2.0 * (2.0 - 1.0))
    assert out[(1, "b")] == pytest.approx(-3.0 * (3.0 - 1.0))
    assert out[(2, "a")] == pytest.approx(2.0 * (-1.0 - 1.0))


def test_sampled_shapley_background_bounds_and_missing_values(spark):
    df = spark.createDataFrame([(1, 2.0, None), (1, 2.0, 3.0)], "id long, a double, b double")
    bg = spark.createDataFrame([(1.0, 1.0), (3.0, float("nan"))], "a double, b double")

    def only_a(c):
        return c["a"] + F.coalesce(F.nanvl(c["b"], F.lit(0.0)), F.lit(0.0)) * 0
    out = explain.sampled_shapley(df, bg, "id", ["a", "b"], only_a, n_perm=8).collect()
    assert len(out) == 4  # repeated ids stay rows of their own
    assert all(r.shap == 0 for r in out if r.feature == "b")
    assert len({r.shap for r in out if r.feature == "a"}) == 1 and all(abs(r.shap) <= 1 for r in out)
    with pytest.raises(ValueError):
        explain.sampled_shapley(df, bg.limit(0), "id", ["a", "b"], only_a)


def test_degradation_frame_is_time_not_rows(spark):
    t0 = datetime(2024, 1, 1)
    rows = [(t0, 0.9), (t0 + timedelta(hours=1), 0.8), (t0 + timedelta(hours=30), 0.5), (t0 + timedelta(hours=31), 0.4)]
    df = spark.createDataFrame(rows, "window_start timestamp, f1 double")
    out = {r.f1: (r.trailing_f1, r.degraded) for r in monitor.degradation(df, "window_start", "f1").collect()}
    assert out[0.9] == (None, False) and out[0.8][0] == pytest.approx(0.9) and out[0.8][1]
    assert out[0.5] == (None, False)  # the rows before it are over 24 hours old
    assert out[0.4][0] == pytest.approx(0.5) and out[0.4][1]


def test_broadcast_check_counts_bytes(spark):
    df = spark.createDataFrame([(1, "x" * 1000), (2, None)], "id long, t string")
    assert materialize_small(df)[1]
    assert not materialize_small(df, max_bytes=1000)[1] and not materialize_small(df, max_rows=1)[1]
    assert materialize_small(df.limit(0))[1]


def test_reweigh_multi_without_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 0), (None, "x", 1), ("b", None, None), ("b", "x", 0)], "g string, h string, y int")
    want = sorted(map(str, weights.reweigh_multi(df, ["g", "h"], "y").collect()))
    monkeypatch.setattr(weights, "materialize_small", lambda t: (materialize_small(t)[0], False))
    assert sorted(map(str, weights.reweigh_multi(df, ["g", "h"], "y").collect())) == want and len(want) == 5


def test_lime_tabular_recovers_linear_weights(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0)], "id long, a double, b double")

    def lin(c):
        return 2.0 * c["a"] - 0.5 * c["b"]
    out = {r.feature: r.weight for r in explain.lime_tabular(
        df, "id", ["a", "b"], lin, {"a": 1.0, "b": 2.0}, n_samples=400).collect()}
    assert out["a"] == pytest.approx(2.0, rel=1e-6)
    assert out["b"] == pytest.approx(-1.0, rel=1e-6)


def test_lime_text_sign(spark):
    docs = spark.createDataFrame([(1, "good bad filler words here good")], "id long, t string")

    def sc(tokens):
        good = F.size(F.filter(tokens, lambda x: x == F.lit("good")))
        bad = F.size(F.filter(tokens, lambda x: x == F.lit("bad")))
        return (good - bad).cast("double")
    w = {r.word: r.weight for r in explain.lime_text(docs, "id", "t", sc, n_samples=200).collect()}
    assert w["good"] > 0.5 and w["bad"] < -0.5 and abs(w["filler"]) < 0.5


def test_linear_shap_additivity(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    coef = {"l_quantity": 0.03, "l_discount": 8.0}
    means = explain.feature_means(li, list(coef))
    assert explain.additivity_error(li, coef, -0.9, means).first().max_error < 1e-9


def test_prefix_counts_many_buckets_equals_plain_window(spark):
    from pyspark.sql.window import Window
    rows = [(k, float(v), (v * 7) % 5 + 1) for k in ("a", "b") for v in range(0, 3000, 3 if k == "a" else 7)]
    df = spark.createDataFrame(rows, "k string, v double, c long")
    got = ranking.prefix_counts(df, "k", "v", ["c"], rows_per_bucket=50)
    w = Window.partitionBy("k").orderBy("v")
    ref = df.select("k", "v", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_c"),
                    F.lead("v").over(w).alias("next_value"))
    a = sorted((r.k, r.v, r.cum_c, r.next_value) for r in got.collect())
    b = sorted((r.k, r.v, r.cum_c, r.next_value) for r in ref.collect())
    assert a == b


def test_range_parts_stay_even_under_a_heavy_tail_and_ties(spark):
    # x = u^-2: quantile knots would leave one bucket with most of the tail
    df = spark.range(40_000).select(F.lit("k").alias("k"), ((F.col("id") + 1) / 40_001.0).alias("u")) \
        .select("k", F.pow("u", F.lit(-2.0)).alias("v"), F.lit(1).alias("c"))
    parts = ranking.range_parts(df, ["k", "v"], 40).groupBy("__part").count()
    assert parts.agg(F.max("count")).first()[0] <= 3 * 40_000 // 40
    # 70 % of the rows tie: their score is one counted row
    tied = spark.range(10_000).select(F.when(F.col("id") % 10 < 7, 0.5).otherwise(F.col("id") / 1e4).alias("s"),
                                      (F.col("id") % 3 == 0).cast("int").alias("y"))
    one = metrics.roc_auc(tied, "y", "s").first()
    many = metrics.roc_auc(tied, "y", "s", rows_per_bucket=50).first()
    assert one == many


def test_prefix_counts_many_keys(spark):
    df = spark.range(30_000).select((F.col("id") % 12_000).cast("string").alias("k"), F.col("id").cast("double").alias("v"), F.lit(1).alias("c"))
    got = ranking.prefix_counts(df, "k", "v", ["c"], rows_per_bucket=1000)
    assert got.count() == 30_000 and got.where("next_value IS NULL").count() == 12_000
    assert got.agg(F.sum("cum_c")).first()[0] == sum(k * (k + 1) // 2 for k in [3] * 6000 + [2] * 6000)


def test_bracket_medians_hot_tie_and_wide(spark):
    from trustframe.operators import stats
    df = spark.range(5001).select(F.when(F.col("id") % 10 < 7, 0.0).otherwise(F.col("id").cast("double")).alias("a"),
                                  F.col("id").cast("double").alias("b"), F.lit(None).cast("double").alias("e"))
    got = {r.feature: r["median"] for r in stats.exact_medians(df, ["a", "b", "e"], accuracy=50, narrow_limit=0, rows_per_bucket=20).collect()}
    assert got == {"a": 0.0, "b": 2500.0, "e": None}


def test_drop_and_require_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert clean.drop_columns(df, ["a", "zz"]).columns == ["b"]
    with pytest.raises(clean.MissingColumnError):
        clean.require_columns(df, ["a", "target"])


def test_request_violation_flag(spark):
    df = spark.createDataFrame([({"spd": 0.05, "eod": 0.2},), ({"spd": 0.01},)],
                               "m map<string,double>")
    got = [r.violation for r in fz.request_violations(df, "m").collect()]
    assert got == [True, False]


def test_combine_rows_no_join(spark):
    from trustframe.functions.joins import combine_rows
    a = spark.range(10).agg(F.count("*").alias("n"))
    b = spark.range(10).agg(F.max("id").alias("mx"))
    r = combine_rows(a, b)
    assert r.first().asDict() == {"n": 10, "mx": 9}
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_seeded_order_reproducible(spark):
    df = spark.range(50).withColumnRenamed("id", "k")
    a = [r.k for r in sampling.seeded_order(df.repartition(5), "k", 9).collect()]
    b = [r.k for r in sampling.seeded_order(df.repartition(1), "k", 9).collect()]
    assert a == b and sorted(a) == list(range(50))


def test_severity_bands(spark):
    m = spark.createDataFrame(
        [("x", "g1", 0.45, 0.0, 0.0, 0.0, 0.0), ("x", "g2", 0.7, 0.0, 0.0, 0.0, 0.0),
         ("x", "g3", 1.0, 0.16, 0.0, 0.0, 0.16), ("x", "g4", 1.0, 0.0, 0.12, 0.0, 0.0),
         ("x", "g5", 1.0, 0.0, 0.0, 0.0, 0.0)],
        "attr string, unpriv_group string, disparate_impact double, statistical_parity_difference "
        "double, equal_opportunity_difference double, average_odds_difference double, "
        "demographic_parity double")
    got = {r.unpriv_group: r.severity for r in fz.severity(m, fz.gate_table(spark)).collect()}
    assert got == {"g1": "high", "g2": "low", "g3": "low", "g4": "minor", "g5": "none"}


def test_round_half_away_matches_duckdb(spark):
    import math
    import random

    import duckdb
    from trustframe.functions.exprs import round_half_away
    rnd = random.Random(1)
    vals = [rnd.uniform(-1000, 1000) for _ in range(3000)] + [k / 2e6 for k in range(-500, 500)] + \
        [0.2734375, -0.2820675, 1e-7, -1e-7, 0.0, -0.0, 2.5e-6, 1e300]
    got = [r.y for r in spark.createDataFrame([(v,) for v in vals], "x double")
           .select(round_half_away(F.col("x"), 6).alias("y")).collect()]
    want = [r[0] for r in duckdb.connect().execute(
        "SELECT round(x, 6) FROM (SELECT unnest(?) AS x)", [vals]).fetchall()]
    assert all(a == b and math.copysign(1, a) == math.copysign(1, b) for a, b in zip(got, want))


def test_edge_cases(spark):
    ref = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    empty = spark.createDataFrame([], "x double")
    r = drift.numeric_drift(ref, empty, ["x"]).first()
    assert r.wasserstein == 0.0 and r.n_cur == 0
    one_class = spark.createDataFrame([(1, 0.3), (1, 0.9)], "y int, s double")
    assert metrics.roc_auc(one_class, "y", "s").first().auc is None
    nulls = spark.createDataFrame([(None,), (None,)], "x double")
    assert stats.exact_medians(nulls, ["x"]).first()["median"] is None
    df = spark.createDataFrame([("b", 1, 1), ("c", 0, 1)], "g string, y int, p int")
    m = fz.fairness_metrics(df, [fz.Protected("g", privileged=["a"])], F.col("y") == 1,
                            F.col("p") == 1).first()
    assert m.n_priv == 0 and m.disparate_impact == 0.0


def test_null_majority_keeps_its_rows(spark):
    df = spark.createDataFrame([(i, None if i < 60 else "a") for i in range(100)], "id int, g string")
    n = {r.bias_group: r["count"] for r in sampling.inject_bias(df, "g", "id").groupBy("bias_group").count().collect()}
    assert n == {"majority": 60, "minority": 40}


def test_strata_with_missing_values_and_separators_stay_apart(spark):
    df = spark.createDataFrame([(1, "a", None, "b"), (1, "a", "b", None), (1, "a_b", "c", "d"), (1, "a", "b_c", "d")],
                               "y int, p string, q string, r string")
    rows = df.unionByName(df)
    for _ in range(4):
        rows = rows.unionByName(rows)
    key, rule = sampling.composite_strata(rows, "y", ["p", "q", "r"])
    assert rule == "composite" and rows.select(key.alias("k")).distinct().count() == 4


def test_growing_a_small_class_in_blocks(spark, monkeypatch):
    df = spark.createDataFrame([(i, "a" if i < 3 else "b") for i in range(103)], "id int, y string")
    whole = sorted(map(tuple, sampling.oversample(df, "y", "id").collect()))
    monkeypatch.setattr(sampling, "COPIES_PER_BLOCK", 7)
    assert sorted(map(tuple, sampling.oversample(df, "y", "id").collect())) == whole and len(whole) == 200


def test_dates_and_flags_drift_by_psi(spark):
    from datetime import date
    ref = spark.createDataFrame([(date(2024, 1, 1 + i % 3), i % 2 == 0, float(i)) for i in range(30)], "d date, b boolean, x double")
    cur = spark.createDataFrame([(date(2024, 2, 1 + i % 3), i % 2 == 0, float(i)) for i in range(30)], "d date, b boolean, x double")
    got = {r.feature: (r.method, r.drifted) for r in drift.feature_drift(ref, cur).collect()}
    assert got == {"d": ("psi", True), "b": ("psi", False), "x": ("wasserstein", False)}


def test_run_gate_fails_on_an_unevaluated_attribute(spark):
    v = spark.createDataFrame([("a", True), ("b", True)], "attr string, overall_pass boolean")
    assert tuple(fz.run_gate(v, ["a", "b"]).first()) == (True, 0)
    assert tuple(fz.run_gate(v, ["a", "b", "c"]).first()) == (False, 1)
    assert tuple(fz.run_gate(v.limit(0), [])
                 .first()) == (False, 0)


def test_encoder_takes_any_number_of_categories(spark, tmp_path):
    df = spark.range(1500).select(F.format_string("c%04d", "id").alias("c"), F.col("id").cast("double").alias("x"))
    m = encode.fit_encoder(df, ["x"], ["c"])
    assert m.width() == 1 + 1499
    with pytest.raises(ValueError):
        m.feature_names()
    m.save(spark, str(tmp_path / "enc"))
    again = encode.EncoderModel.load(spark, str(tmp_path / "enc"))
    for e in (m, again):
        rows = {r.c: (r["size"], r["indices"]) for r in e.transform(df, keep=["c"], output="sparse").collect()}
        assert rows["c0000"] == (1500, [0]) and rows["c0001"] == (1500, [0, 1]) and rows["c1499"] == (1500, [0, 1499])


def test_batch_compared_with_a_profile_reads_no_reference(spark):
    ref = spark.createDataFrame([(float(i), "ab"[i % 2]) for i in range(50)], "x double, s string")
    cur = spark.createDataFrame([(float(i) * 2, "aab"[i % 3]) for i in range(40)], "x double, s string")
    a = drift.feature_drift(ref, cur).orderBy("feature").collect()
    b = drift.drift_from_profile(drift.reference_profile(ref, ["x"], ["s"]), cur).orderBy("feature").collect()
    assert a == b


def test_monitor_batch_alerts(spark):
    ref = spark.createDataFrame([(float(i % 10), "ab"[i % 2], i % 2) for i in range(100)], "x double, s string, p int")
    cur = spark.createDataFrame([(float(i % 10) * 3, "ab"[i % 2], int(i % 4 == 0), i % 2, i % 2 == 0) for i in range(100)],
                                "x double, s string, p int, y int, g boolean")
    prof = drift.reference_profile(ref, ["x", "p"], ["s"])
    got = {(r.drift_type, r.metric): r for r in monitor.monitor_batch(
        cur, prof, F.col("y") == 1, F.col("p") == 1, F.col("g"), "p", reference_f1=0.9).collect()}
    assert set(got) == {("data_drift", "x"), ("prediction_drift", "p"), ("fairness", "statistical_parity_difference"), ("performance", "f1")}
    assert got["performance", "f1"].current_value == 0.0 and got["performance", "f1"].severity == "high"
    assert got["fairness", "statistical_parity_difference"].current_value == -0.5
