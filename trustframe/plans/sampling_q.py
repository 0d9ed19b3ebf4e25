"""Exact seeded splits and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from trustframe.operators import sampling as sm
from trustframe.plans.registry import T, register


def key_sql(id_col: str, seed: int = 42) -> str:
    return f"md5(concat('{seed}:', CAST({id_col} AS VARCHAR)))"


def ceil_sql(n: str, share: float) -> str:
    num = int(round(share * 1_000_000))
    return f"(({n}) * {num} + 999999) // 1000000"


def split_sql(src: str, cols: str, strata: str, id_col: str, test=0.2, val=0.1) -> str:
    vs = val / (1 - test)
    nt = ceil_sql("n", test)
    if val:
        nv = ceil_sql(f"n - {nt}", vs)
        case = (f"CASE WHEN rn <= {nt} THEN 'test' WHEN rn <= {nt} + {nv} THEN 'val' "
                f"ELSE 'train' END")
    else:
        case = f"CASE WHEN rn <= {nt} THEN 'test' ELSE 'train' END"
    part = f"PARTITION BY {strata}" if strata else ""
    return f"""
SELECT {cols}, {case} AS split FROM (
  SELECT *, row_number() OVER ({part} ORDER BY {key_sql(id_col)}, {id_col}) AS rn,
         count(*) OVER ({part}) AS n FROM {src} s) r"""


def resample_sql(src: str, cols: str, strata: str, id_col: str, target: str) -> str:
    """target: SQL over n and strata columns."""
    return f"""
SELECT {cols}, CAST(unnest(range(0, nc)) AS INTEGER) AS copy FROM (
  SELECT *, CASE WHEN t > n THEN t // n + CASE WHEN rn <= t % n THEN 1 ELSE 0 END
                 ELSE CASE WHEN rn <= t THEN 1 ELSE 0 END END AS nc FROM (
    SELECT *, {target} AS t FROM (
      SELECT *, row_number() OVER (PARTITION BY {strata} ORDER BY {key_sql(id_col)}, {id_col}) AS rn,
             count(*) OVER (PARTITION BY {strata}) AS n FROM {src} s) a) b) c
WHERE nc > 0"""


@register("split_stratified", split_sql("orders", "o_orderkey, o_orderstatus", "o_orderstatus",
                                        "o_orderkey"))
def split_stratified(spark, sf):
    """Exact 70/10/20 per o_orderstatus (test = ceil(0.2n), val =
    ceil(0.125 * rest))."""
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return sm.stratified_split(o, ["o_orderstatus"], "o_orderkey", 42)


@register("split_train_test", split_sql("orders", "o_orderkey, o_orderpriority", "o_orderpriority",
                                        "o_orderkey", 0.2, 0.0))
def split_train_test(spark, sf):
    """Two-way 80/20 split stratified on o_orderpriority."""
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return sm.stratified_split(o, ["o_orderpriority"], "o_orderkey", 42, 0.2, 0.0)


_LBL = "(SELECT l.doc_id, l.quality, d.lang FROM labels l JOIN documents d USING (doc_id))"


@register("split_composite_fallback", f"""
WITH s AS (SELECT *, concat_ws('_', CAST(quality AS VARCHAR), lang) AS comp FROM {_LBL} x),
rule AS (SELECT CASE WHEN min(c) >= 10 THEN 'composite' ELSE 'label' END AS rule
         FROM (SELECT comp, count(*) AS c FROM s GROUP BY comp) g),
k AS (SELECT s.*, CASE WHEN rule.rule = 'composite' THEN comp ELSE CAST(quality AS VARCHAR) END
        AS stratum, rule.rule FROM s, rule)
{split_sql("k", "doc_id, quality, lang, stratum, rule", "stratum", "doc_id")}""")
def split_composite_fallback(spark, sf):
    """Stratify on label_lang unless a stratum has < 10 rows, then label."""
    lb = T(spark, sf, "labels").join(T(spark, sf, "documents").select("doc_id", "lang"), "doc_id") \
        .select("doc_id", "quality", "lang")
    key, rule = sm.composite_strata(lb, "quality", ["lang"])
    lb = lb.withColumn("stratum", key).withColumn("rule", F.lit(rule))
    return sm.stratified_split(lb, ["stratum"], "doc_id", 42)


_CELLS = "(SELECT o_orderkey, o_orderstatus, CAST(o_totalprice > 250000 AS INTEGER) AS y FROM orders)"


@register("sample_balanced_cells", f"""
WITH c AS {_CELLS},
m AS (SELECT min(n) AS m FROM (SELECT count(*) AS n FROM c GROUP BY o_orderstatus, y) g)
SELECT o_orderkey, o_orderstatus, y FROM (
  SELECT c.*, row_number() OVER (PARTITION BY o_orderstatus, y ORDER BY {key_sql('o_orderkey')},
         o_orderkey) AS rn FROM c) r, m
WHERE rn <= m.m""")
def sample_balanced_cells(spark, sf):
    """M4: every (status, label) cell cut to the smallest cell's size."""
    c = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus",
                                      (F.col("o_totalprice") > 250000).cast("int").alias("y"))
    return sm.balanced_cells(c, "o_orderstatus", "y", "o_orderkey", 42)


ORACLE_BIAS = f"""
WITH maj AS (SELECT o_orderstatus AS m FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
tot AS (SELECT count(*) AS n FROM orders),
g AS (SELECT o_orderkey, o_orderstatus,
        CASE WHEN o_orderstatus = (SELECT m FROM maj) THEN 'majority' ELSE 'minority' END AS bias_group
      FROM orders)
{resample_sql("g", "o_orderkey, o_orderstatus, bias_group", "bias_group", "o_orderkey",
              "CASE WHEN bias_group = 'majority' THEN CAST(floor((SELECT n FROM tot) * 0.6) AS BIGINT) "
              "ELSE CAST(floor((SELECT n FROM tot) * 0.4) AS BIGINT) END")}"""


@register("bias_inject", ORACLE_BIAS)
def bias_inject(spark, sf):
    """M8: largest status group to 60 % of n, the rest to 40 % (copies when
    growing, seeded subset when shrinking)."""
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return sm.inject_bias(o, "o_orderstatus", "o_orderkey", (0.6, 0.4), 42)


@register("oversample_random", f"""
WITH top AS (SELECT max(c) AS t FROM (SELECT count(*) AS c FROM labels GROUP BY quality) g)
{resample_sql("labels", "doc_id, quality", "quality", "doc_id", "(SELECT t FROM top)")}""")
def oversample_random(spark, sf):
    """M9: every class up to the largest class (U1: union of resampled classes)."""
    lb = T(spark, sf, "labels").select("doc_id", "quality")
    return sm.oversample(lb, "quality", "doc_id", 42)


@register("explain_sample_groups", f"""
SELECT event_id, event_type, 'group' AS scope FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY {key_sql('event_id')}, event_id) AS rn
  FROM events) a WHERE rn <= 3
UNION ALL
SELECT event_id, event_type, 'overall' FROM (
  SELECT *, row_number() OVER (ORDER BY {key_sql('event_id')}, event_id) AS rn FROM events) b
WHERE rn <= 5""")
def explain_sample_groups(spark, sf):
    """M14 + W1: 3 rows per group and 5 overall, seeded."""
    ev = T(spark, sf, "events").select("event_id", "event_type")
    g = sm.sample_per_group(ev, "event_type", "event_id", 3).withColumn("scope", F.lit("group"))
    a = sm.sample_per_group(ev, None, "event_id", 5).withColumn("scope", F.lit("overall"))
    return g.unionByName(a)
