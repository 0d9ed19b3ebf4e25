"""Queries over the branches that small tables do not reach by themselves (many
parts, many keys, wide categories, stored profiles) and over the readers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T_

from trustframe.operators import clean
from trustframe.operators import drift as dr
from trustframe.operators import encode as en
from trustframe.operators import fairness as fz
from trustframe.operators import metrics as mt
from trustframe.operators import repair as rp
from trustframe.operators import stats
from trustframe.operators import weights as wt
from trustframe.plans import bindings as B
from trustframe.plans import clean_q, drift_q, fairness_q, metrics_q, registry, sampling_q, sources_q  # noqa: F401  their SQL is used
from trustframe.plans.registry import T, register, rnd
from trustframe.session import ensure_checkpoint_dir
from trustframe.sources import readers


def _same_sql(name: str) -> str:
    """The SQL of a query whose result must not depend on sizes set low here."""
    return registry.ORACLE[name]


@register("column_medians_bracket", _same_sql("column_medians"))
def column_medians_bracket(spark, sf):
    """A5 through the verified bracket: no column counts as narrow, a coarse sketch, small parts."""
    return stats.exact_medians(T(spark, sf, "orders"), ["o_totalprice", "o_custkey"], accuracy=200, narrow_limit=0, rows_per_bucket=50)


@register("roc_auc_parts", _same_sql("roc_auc"))
def roc_auc_parts(spark, sf):
    """A13 over many parts of the score range."""
    return mt.roc_auc(metrics_q.scored(spark, sf), "y", "p", rows_per_bucket=500)


@register("roc_auc_many_keys", rnd(
    f"SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, n_pos, n_neg, auc FROM ({metrics_q.auc_sql(metrics_q.SCORED_SQL, 'l_orderkey')}) a", ["auc"]))
def roc_auc_many_keys(spark, sf):
    """A13 per order: as many keys as orders."""
    return mt.roc_auc(metrics_q.scored(spark, sf), "y", "p", "l_orderkey", rows_per_bucket=2000)


@register("drift_wasserstein_parts", _same_sql("drift_wasserstein"))
def drift_wasserstein_parts(spark, sf):
    """D1 + W4 over many parts of the value range."""
    ref, cur = drift_q.halves(spark, sf)
    full = registry.QUERIES["drift_wasserstein"](spark, sf).columns
    return dr.numeric_drift(ref, cur, drift_q.NUM, rows_per_bucket=200).select(*full)


@register("drift_from_profile", _same_sql("drift_features"))
def drift_from_profile(spark, sf):
    """D4 + D6: the reference is stored as a profile, read back, and compared with the batch."""
    ref, cur = drift_q.halves(spark, sf)
    path = f"{ensure_checkpoint_dir(spark)}/profile-{uuid.uuid4().hex}"
    dr.reference_profile(ref, drift_q.NUM, drift_q.CAT).write.parquet(path)
    return dr.drift_from_profile(spark.read.parquet(path), cur.drop("pred"))


@register("repair_quantile_parts", _same_sql("repair_quantile"))
def repair_quantile_parts(spark, sf):
    """M10 over many parts of the value range."""
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return rp.quantile_repair(o, "o_totalprice", "o_orderstatus", 100, rows_per_bucket=100)


@register("distinct_counts", """
SELECT 'o_orderkey' AS feature, count(DISTINCT o_orderkey)::BIGINT AS n_distinct FROM orders
UNION ALL SELECT 'o_totalprice', count(DISTINCT o_totalprice) FROM orders
UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) FROM orders""")
def distinct_counts(spark, sf):
    """Exact distinct counts of narrow and wide columns."""
    return stats.distinct_counts(T(spark, sf, "orders"), ["o_orderkey", "o_totalprice", "o_orderstatus"])


@register("encode_wide_sparse", rnd("""
WITH c AS (SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS pos FROM (SELECT DISTINCT c_name FROM customer) d),
m AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 AS pos FROM (SELECT DISTINCT c_mktsegment FROM customer) d),
k AS (SELECT (SELECT count(*) FROM c) AS kc, (SELECT count(*) FROM m) AS km)
SELECT c_custkey, (kc - 1 + km - 1)::BIGINT AS size,
  concat_ws(',', CASE WHEN c.pos >= 1 THEN (c.pos - 1)::VARCHAR END, CASE WHEN m.pos >= 1 THEN (kc - 1 + m.pos - 1)::VARCHAR END) AS indices
FROM customer JOIN c USING (c_name) JOIN m USING (c_mktsegment), k""", []))
def encode_wide_sparse(spark, sf):
    """X3 with more categories than are listed: places from a table, sparse output."""
    c = T(spark, sf, "customer")
    m = en.fit_encoder(c, [], ["c_name", "c_mktsegment"], max_listed=100)
    s = m.transform(c, keep=["c_custkey"], output="sparse")
    return s.select("c_custkey", "size", F.array_join(F.transform("indices", lambda i: i.cast("string")), ",").alias("indices"))


@register("fairness_unknown_gate", f"""
WITH m AS ({fairness_q.sql_metrics(B.ORD_SQL, "pairwise")})
SELECT attr, unpriv_group, 'dp_label' AS metric, round(dp_label, 6) AS value, -0.5::DOUBLE AS lo, 0.5::DOUBLE AS hi,
  coalesce(dp_label BETWEEN -0.5 AND 0.5, false) AS pass FROM m
UNION ALL SELECT attr, unpriv_group, 'no_such_metric', NULL, 0.0, 1.0, false FROM m""")
def fairness_unknown_gate(spark, sf):
    """J5 + F10: gates on any metric of the table; a gate on an absent metric fails."""
    m = fz.fairness_metrics(T(spark, sf, "orders"), B.ORD_ATTRS, B.ORD_LABEL(), B.ORD_PRED(), "pairwise")
    return fz.apply_gates(m, fz.gate_table(spark, [("dp_label", -0.5, 0.5), ("no_such_metric", 0.0, 1.0)]))


@register("mitigation_sampling", f"""
SELECT o_orderkey, o_orderstatus, y, 1.0::DOUBLE AS weight FROM ({_same_sql("sample_balanced_cells")}) s""")
def mitigation_sampling(spark, sf):
    """M6: the dispatcher's 'sampling' method gives balanced cells with unit weights."""
    c = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus", (F.col("o_totalprice") > 250000).cast("int").alias("y"))
    return wt.mitigation_weights(c, "sampling", ["o_orderstatus"], "y", id_col="o_orderkey")


def _csv(spark, df, header: bool) -> str:
    path = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    df.write.option("header", header).csv(path)
    return path


@register("csv_headered", """
SELECT c_custkey::INTEGER AS id, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS "Attrition",
  coalesce(CASE WHEN c_custkey % 10 <> 0 THEN c_nationkey END,
           (SELECT median(CASE WHEN c_custkey % 10 <> 0 THEN c_nationkey END) FROM customer))::DOUBLE AS nation
FROM customer""")
def csv_headered(spark, sf):
    """S1 + P1 + P2: a headered CSV of customers read with its schema: target mapped, fixed
    columns dropped, missing numbers imputed."""
    c = T(spark, sf, "customer").select(
        F.col("c_custkey").cast("int").alias("id"), F.when(F.col("c_custkey") % 3 == 0, "Yes").otherwise("No").alias("Attrition"),
        F.when(F.col("c_custkey") % 10 != 0, F.col("c_nationkey")).cast("double").alias("nation"), F.lit(1).alias("EmployeeCount"))
    schema = "id int, Attrition string, nation double, EmployeeCount int"
    return readers.read_headered_csv(spark, _csv(spark, c, True), T_.StructType.fromDDL(schema)).select("id", "Attrition", "nation")


@register("csv_fixed", """
SELECT c_custkey::DOUBLE AS age, coalesce(CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END, m.v) AS workclass,
  CASE c_custkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS income
FROM customer, (SELECT c_mktsegment AS v FROM customer WHERE c_custkey % 7 <> 0 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) m""")
def csv_fixed(spark, sf):
    """A file without header under fixed names; '?' is missing and imputed, labels outside
    the map stay missing."""
    c = T(spark, sf, "customer")
    k = F.col("c_custkey") % 4
    cols = {n: F.lit("x") if n not in readers.ADULT_NUMERIC else F.lit(1) for n in readers.ADULT_COLUMNS}
    cols |= {"age": F.col("c_custkey"), "workclass": F.when(F.col("c_custkey") % 7 == 0, " ?").otherwise(F.concat(F.lit(" "), F.col("c_mktsegment"))),
             "income": F.when(k == 0, " >50K").when(k == 1, " <=50K").when(k == 2, " >50K.").otherwise(" ?")}
    path = _csv(spark, c.select(*[v.cast("string").alias(n) for n, v in cols.items()]), False)
    return readers.read_fixed_csv(spark, path).select("age", "workclass", "income")


@register("csv_required", """
SELECT c_custkey::INTEGER AS id, (c_custkey % 5 = 0)::INTEGER AS hospital_expire_flag,
  CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment ELSE m.v END AS unit, 'Unknown' AS note
FROM customer, (SELECT c_mktsegment AS v FROM customer WHERE c_custkey % 4 <> 0 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) m
WHERE c_custkey % 12 <> 0""")
def csv_required(spark, sf):
    """S3: a required file; sparse rows go, a column without values is 'Unknown'."""
    k = F.col("c_custkey")
    c = T(spark, sf, "customer").select(
        k.cast("int").alias("id"), (k % 5 == 0).cast("int").alias("hospital_expire_flag"),
        F.when(k % 4 != 0, F.col("c_mktsegment")).alias("unit"), F.lit(None).cast("string").alias("note"),
        F.when(k % 6 != 0, F.lit("a")).alias("other"), k.alias("subject_id"))
    schema = T_.StructType.fromDDL("id int, hospital_expire_flag int, unit string, note string, other string, subject_id int")
    return readers.read_required_csv(spark, _csv(spark, c, True), schema=schema).select("id", "hospital_expire_flag", "unit", "note")


@register("drop_and_require", "SELECT o_orderkey, o_custkey FROM orders")
def drop_and_require(spark, sf):
    """P1 + P2: columns required, then all others but two dropped."""
    o = T(spark, sf, "orders")
    clean.require_columns(o, ["o_orderkey", "o_custkey"])
    return clean.drop_columns(o, [c for c in o.columns if c not in ("o_orderkey", "o_custkey")] + ["absent"])

