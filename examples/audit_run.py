"""End-to-end audit on the provided tables, the way a user of the reference
runs its full flow: validate -> split -> encode -> reweigh -> train ->
evaluate -> fairness gates -> attribution -> drift. Every step is a Spark
job; only O(groups) results are printed.

usage: python examples/audit_run.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.ml.functions import vector_to_array  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from trustframe.operators import drift, encode, explain, fairness, metrics, models  # noqa: E402
from trustframe.operators import sampling, validate, weights  # noqa: E402
from trustframe.session import ensure_checkpoint_dir, get_spark  # noqa: E402
from trustframe.sources import table  # noqa: E402


def main(sf_dir: str) -> None:
    spark = get_spark("local[8]", 16, "trustframe-audit")
    ensure_checkpoint_dir(spark)

    # data: orders with a seeded derived label (price and order age plus noise;
    # the fixture columns are independent, so a label with known signal is
    # derived) and a protected attribute
    u = F.conv(F.substring(F.md5(F.concat(F.lit("lbl:"), F.col("o_orderkey").cast("string"))),
                           1, 8), 16, 10).cast("double") / F.lit(float(16 ** 8))
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority",
        (F.col("o_totalprice") / 100000.0).alias("price"),
        (F.datediff("o_orderdate", F.lit("1995-01-01")) / 365.0).alias("days"), u.alias("u"))
    o = o.withColumn("y", ((F.col("price") * 0.4 + F.col("days") * 0.15 + F.col("u")) > 1.9)
                     .cast("double")).drop("u")

    print("validation:", validate.validation_report(o, "y", ["o_orderstatus", "gender"]).first())

    s = sampling.stratified_split(o, ["y"], "o_orderkey", 42)               # 70/10/20, exact
    enc = encode.fit_encoder(s.where("split = 'train'"), ["price", "days"], ["o_orderpriority"])
    x = enc.transform(s, keep=["o_orderkey", "o_orderstatus", "y", "split"])
    x = weights.reweigh_rows(x, "o_orderstatus", "y")                        # fairness weights
    feats = enc.feature_names()
    x = models.assemble(x, feats).cache()

    model = models.train(x.where("split = 'train'"), "logistic_regression", "y", "weight")
    test = model.transform(x.where("split = 'test'")).select(
        "o_orderkey", "o_orderstatus", "y",
        vector_to_array("probability")[1].alias("p"), F.col("prediction").alias("yhat"))
    print("performance:", metrics.confusion(test, "y", "yhat").first())
    print("roc_auc:", metrics.roc_auc(test, "y", "p").first())

    attrs = [fairness.Protected("o_orderstatus", privileged=["F"])]
    m = fairness.fairness_metrics(test, attrs, F.col("y") == 1, F.col("yhat") == 1, "pairwise")
    gates = fairness.apply_gates(m, fairness.gate_table(spark))
    for r in fairness.verdict(gates).collect():
        print("fairness gate:", r.attr, "PASS" if r.overall_pass else f"FAIL ({r.failed_metrics})")

    imp = models.importance(spark, model, feats)
    print("importance:", [(r.feature, round(r.importance, 4)) for r in imp.collect()])
    coef = dict(zip(feats, [float(v) for v in model.coefficients.toArray()]))
    local = explain.linear_shap(x.where("split = 'test'"), coef, ["o_orderkey"])
    print("mean |phi|:", [(r.feature, round(r.importance, 4)) for r in
                          explain.global_importance(local).orderBy("rank").collect()])

    ref = o.where(F.col("days") < 3.0).drop("o_orderkey")
    cur = o.where(F.col("days") >= 3.0).drop("o_orderkey")
    print("drift:", drift.overall_drift(drift.feature_drift(ref, cur)).first())
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
