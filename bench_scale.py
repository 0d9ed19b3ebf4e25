"""Scaling check: headline operators on lineitem / orders replicated x1, x10,
x100 inside the plan (explode of a sequence; each copy gets a unique id and a
small value offset so distinct-value histograms grow with the copies).
Prints one JSON line per factor with seconds and rows/s."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from trustframe.operators import fairness as fz, metrics as mt, sampling as sm, scoring as sc  # noqa: E402
from trustframe.session import ensure_checkpoint_dir, get_spark  # noqa: E402

COEF = {"l_quantity": 0.03, "l_discount": 8.0, "l_tax": -5.0, "l_extendedprice": -0.00001}


def replicate(df, k, cols_offset):
    r = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("rep"))
    for c in cols_offset:
        r = r.withColumn(c, F.col(c) + F.col("rep") * F.lit(1e-3))
    return r


def run(fn):
    t0 = time.perf_counter()
    fn().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    factors = [int(x) for x in (sys.argv[1:] or ["1", "10", "100"])]
    spark = get_spark(f"local[{cpus}]", int(cpus) * 4, "trustframe-scale")
    ensure_checkpoint_dir(spark)
    li0 = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    o0 = spark.read.parquet(f"{sf_dir}/orders.parquet")
    n_li, n_o = li0.count(), o0.count()
    for k in factors:
        li = replicate(li0, k, ["l_extendedprice"])
        o = replicate(o0, k, ["o_totalprice"]).withColumn(
            "oid", F.col("o_orderkey") * F.lit(1000) + F.col("rep"))
        attrs = [fz.Protected("l_linestatus", privileged=["O"]),
                 fz.Protected("l_returnflag", privileged=["A"])]
        t = {
            "fairness_audit": run(lambda: fz.apply_gates(
                fz.fairness_metrics(li, attrs, F.col("l_returnflag") == "R", F.col("l_discount") >= 0.05),
                fz.gate_table(spark))),
            "score_batch": run(lambda: sc.score_linear(li, COEF, -0.9, ["l_orderkey"], "v1",
                                                       __import__("datetime").datetime(2024, 2, 1))),
            "roc_auc": run(lambda: mt.roc_auc(li.select(
                (F.col("l_returnflag") == "R").cast("int").alias("y"),
                sc.sigmoid(sc.linear_margin(COEF, -0.9)).alias("p")), "y", "p")),
            "stratified_split": run(lambda: sm.stratified_split(
                o.select("oid", "o_orderstatus"), ["o_orderstatus"], "oid", 42)),
        }
        rows = {"fairness_audit": n_li * k, "score_batch": n_li * k, "roc_auc": n_li * k,
                "stratified_split": n_o * k}
        print(json.dumps({"factor": k, "sec": t,
                          "rows_per_sec": {q: round(rows[q] / t[q]) for q in t}}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
