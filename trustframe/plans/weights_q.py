"""Reweighing and class-balance weight queries."""

from __future__ import annotations


from trustframe.operators import weights as wt
from trustframe.plans.registry import T, register, rnd

_D = "(SELECT d.doc_id, d.lang, d.source, l.quality FROM documents d JOIN labels l USING (doc_id))"


def _docs(spark, sf):
    return T(spark, sf, "documents").select("doc_id", "lang", "source") \
        .join(T(spark, sf, "labels").select("doc_id", "quality"), "doc_id")


def _w_sql(a: str, cells: str = "c") -> str:
    return f"""(SELECT {a}, quality, n_gy,
  CASE WHEN n_gy > 0 THEN (sum(n_gy) OVER (PARTITION BY {a}) * sum(n_gy) OVER (PARTITION BY quality))::DOUBLE
       / (sum(n_gy) OVER () * n_gy) ELSE 1.0 END AS w
  FROM (SELECT {a}, quality, sum(n) AS n_gy FROM {cells} GROUP BY {a}, quality) m)"""


@register("reweigh_table", rnd(f"""
WITH c AS (SELECT lang, quality, count(*) AS n FROM {_D} d GROUP BY lang, quality)
SELECT lang, quality, n_gy::BIGINT AS n_cell, w AS weight FROM {_w_sql('lang')} t""", ["weight"]))
def reweigh_table(spark, sf):
    """M1: w(g, y) = P(g)P(y)/P(g, y) for lang x quality."""
    return wt.reweigh_table(_docs(spark, sf), "lang", "quality")


@register("reweigh_rows", rnd(f"""
WITH d AS {_D}, c AS (SELECT lang, quality, count(*) AS n FROM d GROUP BY lang, quality)
SELECT d.doc_id, d.lang, d.source, d.quality, coalesce(t.w, 1.0) AS weight
FROM d LEFT JOIN {_w_sql('lang')} t ON d.lang = t.lang AND d.quality = t.quality""", ["weight"]))
def reweigh_rows(spark, sf):
    """M2 + J2: each row joined to its (group, label) weight."""
    return wt.reweigh_rows(_docs(spark, sf), "lang", "quality")


@register("reweigh_multi_attr", rnd(f"""
WITH d AS {_D}, c AS (SELECT lang, source, quality, count(*) AS n FROM d GROUP BY ALL),
wl AS {_w_sql('lang')}, ws AS {_w_sql('source')},
p AS (SELECT c.lang, c.source, c.quality, c.n, wl.w * ws.w AS raw FROM c
      JOIN wl ON c.lang = wl.lang AND c.quality = wl.quality
      JOIN ws ON c.source = ws.source AND c.quality = ws.quality),
m AS (SELECT sum(n * raw) / sum(n) AS mean FROM p)
SELECT d.doc_id, d.lang, d.source, d.quality, p.raw / m.mean AS weight
FROM d JOIN p ON d.lang = p.lang AND d.source = p.source AND d.quality = p.quality, m""",
    ["weight"]))
def reweigh_multi_attr(spark, sf):
    """M3: product over lang and source weights, normalised to mean 1."""
    return wt.reweigh_multi(_docs(spark, sf), ["lang", "source"], "quality")


@register("class_balanced_weights", rnd("""
WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality)
SELECT l.doc_id, l.quality, (SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * c.n) AS weight
FROM labels l JOIN c USING (quality)""", ["weight"]))
def class_balanced_weights(spark, sf):
    """M5: n / (k * n_y)."""
    lb = T(spark, sf, "labels").select("doc_id", "quality")
    return wt.class_balanced_weights(lb, "quality")


@register("reweigh_parity", rnd(f"""
WITH d AS {_D}, c AS (SELECT lang, quality, count(*) AS n FROM d GROUP BY lang, quality),
r AS (SELECT d.lang, d.quality, coalesce(t.w, 1.0) AS weight
      FROM d LEFT JOIN {_w_sql('lang')} t ON d.lang = t.lang AND d.quality = t.quality)
SELECT lang, sum(weight * quality) / sum(weight) AS rate, sum(weight) AS total_weight
FROM r GROUP BY lang""", ["rate", "total_weight"]))
def reweigh_parity(spark, sf):
    """Property: after reweighing, the weighted label rate is equal in every group."""
    r = wt.reweigh_rows(_docs(spark, sf), "lang", "quality")
    return wt.weighted_selection_rates(r, "lang", "quality", "weight")


@register("mitigation_dispatch", rnd("""
SELECT doc_id, quality, 1.0 AS weight FROM labels""", ["weight"]))
def mitigation_dispatch(spark, sf):
    """M6: unknown method -> unit weights (the dispatcher never fails silently
    into different data)."""
    lb = T(spark, sf, "labels").select("doc_id", "quality")
    return wt.mitigation_weights(lb, "no_such_method", ["lang"], "quality")
