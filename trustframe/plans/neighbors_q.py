"""Neighbour, synthetic-row and preparation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from trustframe.operators import balance as ba
from trustframe.operators import neighbors as nb
from trustframe.plans.registry import T, register, rnd
from trustframe.plans.sampling_q import resample_sql, split_sql


def knn_sql(src: str, dims: int, k: int = 5, f: str = "f[{}]") -> str:
    """id, rank, neighbor, d (squared) from ``src`` (id and, by ``f``, its dimensions): all pairs."""
    square = " + ".join("(a.{0} - b.{0}) * (a.{0} - b.{0})".format(f.format(i)) for i in range(1, dims + 1))
    return f"""
SELECT id, unnest(range(1, len(l) + 1))::INT AS rank, unnest(l).id AS neighbor, unnest(l).d AS d FROM (
  SELECT a.id, min({{'d': {square}, 'id': b.id}}, {k}) AS l FROM {src} a JOIN {src} b ON a.id <> b.id GROUP BY a.id) n"""


_ORDERS = "SELECT o_orderkey AS id, o_totalprice / 10000.0 AS f1, o_custkey / 50.0 AS f2, length(o_orderpriority)::DOUBLE AS f3 FROM orders"


@register("knn_self_join", rnd(f"""
WITH x AS MATERIALIZED ({_ORDERS}) SELECT id AS o_orderkey, rank, neighbor, sqrt(d) AS distance FROM ({knn_sql('x', 3, f='f{}')}) k""", ["distance"]))
def knn_self_join(spark, sf):
    """The 5 nearest orders of every order by price, customer and length of the priority."""
    v = F.array(F.col("o_totalprice") / 10000.0, F.col("o_custkey") / 50.0, F.length("o_orderpriority").cast("double"))
    return nb.knn_self_join(T(spark, sf, "orders"), "o_orderkey", v, 5)


_EMBEDDED = "(SELECT vec_id AS id, embedding::DOUBLE[] AS f FROM embeddings)"


@register("knn_embeddings", rnd(f"SELECT id AS vec_id, rank, neighbor, sqrt(d) AS distance FROM ({knn_sql(_EMBEDDED, 64, 10)}) k", ["distance"]))
def knn_embeddings(spark, sf):
    """J7 in 64 dimensions: the 10 nearest embeddings of every embedding."""
    return nb.knn_self_join(T(spark, sf, "embeddings"), "vec_id", F.col("embedding"), 10)


def _uniform(what: str, seed: int = 42) -> str:
    return f"(('0x' || substr(md5(concat_ws(':', '{seed}', '{what}', id, copy)), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def smote_sql(src: str, dims: int, k: int = 5) -> str:
    """id, y, f, synthetic_of, neighbor, copy from ``src`` (id, y, f): class 1 is the smaller one, with over k rows."""
    gap = ", ".join(f"x.f[{i}] + g * (o.f[{i}] - x.f[{i}])" for i in range(1, dims + 1))
    extra = f"(SELECT (count_if(y = 0) - count_if(y = 1))::BIGINT FROM {src} t)"
    return f"""
SELECT id, y, f, NULL::BIGINT AS synthetic_of, NULL::BIGINT AS neighbor, NULL::INT AS copy FROM {src} real
UNION ALL
SELECT NULL, 1, [{gap}], x.id, o.id, x.copy
FROM (SELECT *, floor({_uniform('neighbor')} * {k})::INT + 1 AS nth, {_uniform('gap')} AS g
      FROM ({resample_sql(f"(SELECT * FROM {src} q WHERE y = 1)", "id, y, f", "y", "id", extra)}) c) x
JOIN ({knn_sql(f"(SELECT * FROM {src} q WHERE y = 1)", dims, k)}) n ON n.id = x.id AND n.rank = x.nth
JOIN {src} o ON o.id = n.neighbor"""


_EVENTS = "(SELECT event_id AS id, (event_type = 'error')::INT AS y, [value, user_id / 10.0, hour(ts)::DOUBLE] AS f FROM events)"


@register("smote", rnd(f"""
SELECT id AS event_id, y, f[1] AS f0, f[2] AS f1, f[3] AS f2, synthetic_of, neighbor, copy FROM ({smote_sql(_EVENTS, 3)}) s""", ["f0", "f1", "f2"]))
def smote(spark, sf):
    """M7: error events grown to the number of the others between their 5 nearest neighbours."""
    ev = T(spark, sf, "events").withColumn("y", (F.col("event_type") == "error").cast("int"))
    v = F.array("value", F.col("user_id") / 10.0, F.hour("ts").cast("double"))
    s = ba.smote(ev, "event_id", "y", v, 5)
    return s.select("event_id", "y", *[F.col("features")[i].alias(f"f{i}") for i in range(3)], "synthetic_of", "neighbor", "copy")


_PREP = "(SELECT o_orderkey, (o_custkey % 8 = 0)::INT AS y, o_totalprice, o_orderdate, o_orderpriority FROM orders)"
_PRI = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _prepare_sql():
    hot = ", ".join(f"CASE WHEN o_orderpriority = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" for v in _PRI[1:])
    names = ["o_totalprice", "day"] + [f"o_orderpriority_{v}" for v in _PRI[1:]]
    s = split_sql(_PREP, "o_orderkey, y, o_totalprice, date_part('day', o_orderdate)::DOUBLE AS day, o_orderpriority", "y", "o_orderkey")
    return f"""
WITH s AS MATERIALIZED ({s}),
p AS (SELECT avg(o_totalprice) AS m0, stddev_pop(o_totalprice) AS s0, avg(day) AS m1, stddev_pop(day) AS s1 FROM s WHERE split = 'train'),
e AS MATERIALIZED (SELECT o_orderkey AS id, split, y, [(o_totalprice - m0) / s0, (day - m1) / s1, {hot}] AS f FROM s, p),
tr AS MATERIALIZED (SELECT id, y, f FROM e WHERE split = 'train'),
b AS (SELECT *, 'train' AS split FROM ({smote_sql("tr", 6)}) t
      UNION ALL SELECT id, y, f, NULL, NULL, NULL, split FROM e WHERE split <> 'train')
SELECT id AS o_orderkey, split, y, {", ".join(f'f[{i + 1}] AS "{n}"' for i, n in enumerate(names))}, synthetic_of, neighbor, copy FROM b"""


@register("prepare_balanced", rnd(_prepare_sql(), ['"o_totalprice"', '"day"'] + [f'"o_orderpriority_{v}"' for v in _PRI[1:]]))
def prepare_balanced(spark, sf):
    """X6 whole: split by label, encoder fitted on train, all splits encoded, train balanced by M7."""
    o = T(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 8 == 0).cast("int").alias("y"), "o_totalprice",
                                      F.dayofmonth("o_orderdate").cast("double").alias("day"), "o_orderpriority")
    rows, enc = ba.prepare(o, "o_orderkey", "y", ["o_totalprice", "day"], ["o_orderpriority"])
    return rows.select("o_orderkey", "split", "y", *[F.col("features")[i].alias(n) for i, n in enumerate(enc.feature_names())],
                       "synthetic_of", "neighbor", "copy")
