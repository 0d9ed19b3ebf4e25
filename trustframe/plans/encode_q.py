"""Encoding queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from trustframe.operators import encode as en
from trustframe.operators import sampling as sm
from trustframe.plans.registry import T, register, rnd
from trustframe.plans.sampling_q import split_sql
from trustframe.session import cut_lineage, ensure_checkpoint_dir

_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("scaler_params", rnd("\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, avg({c}) AS mean, stddev_pop({c}) AS std FROM lineitem"
    for c in _NUM), ["mean", "std"]))
def scaler_params(spark, sf):
    """Mean and population std."""
    return en.scaler_params(T(spark, sf, "lineitem"), _NUM)


@register("standard_scale", rnd(
    "WITH p AS (SELECT " + ", ".join(
        f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}"
        for c in _NUM) + " FROM lineitem)\nSELECT l_orderkey, l_linenumber, " + ", ".join(
        f"({c} - m_{c}) / s_{c} AS {c}" for c in _NUM) + " FROM lineitem, p", _NUM))
def standard_scale(spark, sf):
    """(x - mean) / population std; std 0 -> divide by 1."""
    li = T(spark, sf, "lineitem")
    m = en.fit_encoder(li, _NUM, [])
    return m.transform(li, keep=["l_orderkey", "l_linenumber"])


_PRI = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _onehot_sql(src="orders"):
    cols = []
    for v in ["O", "P"]:
        cols.append(f"CASE WHEN o_orderstatus = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"o_orderstatus_{v}\"")
    for v in _PRI[1:]:
        cols.append(f"CASE WHEN o_orderpriority = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"o_orderpriority_{v}\"")
    return f"SELECT o_orderkey, {', '.join(cols)} FROM {src}"


@register("one_hot", _onehot_sql())
def one_hot(spark, sf):
    """Ascending categories, first dropped, unseen -> all zeros."""
    o = T(spark, sf, "orders")
    m = en.fit_encoder(o, [], ["o_orderstatus", "o_orderpriority"])
    return m.transform(o, keep=["o_orderkey"])


@register("encoder_save_load", _onehot_sql())
def encoder_save_load(spark, sf):
    """Fitted encoder written as a Parquet parameter table and read back."""
    o = T(spark, sf, "orders")
    m = en.fit_encoder(o, [], ["o_orderstatus", "o_orderpriority"])
    path = f"{ensure_checkpoint_dir(spark)}/encoder-{uuid.uuid4().hex}"
    m.save(spark, path)
    return en.EncoderModel.load(spark, path).transform(o, keep=["o_orderkey"])


def _train_apply_sql():
    s = split_sql("orders", "o_orderkey, o_orderstatus, o_totalprice, o_orderpriority",
                  "o_orderstatus", "o_orderkey")
    cats = ", ".join(f"CASE WHEN o_orderpriority = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"o_orderpriority_{v}\""
                     for v in _PRI[1:])
    return f"""
WITH s AS ({s}),
p AS (SELECT avg(o_totalprice) AS m, CASE WHEN stddev_pop(o_totalprice) = 0 THEN 1.0
             ELSE stddev_pop(o_totalprice) END AS sd FROM s WHERE split = 'train')
SELECT o_orderkey, split, (o_totalprice - p.m) / p.sd AS o_totalprice, {cats} FROM s, p"""


@register("encode_train_apply", rnd(_train_apply_sql(), ["o_totalprice"]))
def encode_train_apply(spark, sf):
    """X5 + X6 (without SMOTE): split, fit on train only, apply to every split."""
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice",
                                      "o_orderpriority")
    s = cut_lineage(sm.stratified_split(o, ["o_orderstatus"], "o_orderkey", 42))
    m = en.fit_encoder(s.where(F.col("split") == "train"), ["o_totalprice"], ["o_orderpriority"])
    return m.transform(s, keep=["o_orderkey", "split"])


@register("feature_names", """
SELECT CAST(pos AS INTEGER) AS pos, name FROM (VALUES
  (0, 'l_quantity'), (1, 'l_discount')) t(pos, name)
UNION ALL
SELECT CAST(1 + row_number() OVER (ORDER BY k, v) AS INTEGER), k || '_' || v FROM (
  SELECT 'l_linestatus' AS k, l_linestatus AS v FROM lineitem GROUP BY 2
  UNION ALL SELECT 'l_returnflag', l_returnflag FROM lineitem GROUP BY 2) c
WHERE (k, v) NOT IN (SELECT ('l_linestatus', min(l_linestatus)) FROM lineitem)
  AND (k, v) NOT IN (SELECT ('l_returnflag', min(l_returnflag)) FROM lineitem)""")
def feature_names(spark, sf):
    """Numerics in order, then <col>_<value> per kept category."""
    li = T(spark, sf, "lineitem")
    m = en.fit_encoder(li, ["l_quantity", "l_discount"], ["l_linestatus", "l_returnflag"])
    return spark.createDataFrame(list(enumerate(m.feature_names())), "pos int, name string")
