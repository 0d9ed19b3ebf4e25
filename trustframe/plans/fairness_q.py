"""Fairness queries (F1-F16, A11, A14, A22, A23) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from trustframe.operators import fairness as fz
from trustframe.plans import bindings as B
from trustframe.plans.registry import T, register, rnd

RATES = ["selection_rate", "base_rate", "tpr", "fpr"]
METRICS = ["sr_priv", "sr_unpriv", "tpr_priv", "tpr_unpriv", "fpr_priv", "fpr_unpriv",
           "statistical_parity_difference", "disparate_impact", "equal_opportunity_difference",
           "average_odds_difference", "demographic_parity", "dp_label"]


# ---------------------------------------------------------------- SQL builders
def sql_groups(b: dict) -> str:
    tags = " UNION ALL ".join(
        f"SELECT '{n}' AS attr, {g} AS grp, coalesce({p}, false) AS priv, "
        f"CAST({b['label']} AS INTEGER) AS y, CAST({b['pred']} AS INTEGER) AS p FROM {b['source']} s"
        for n, g, p in b["attrs"])
    return f"""
SELECT attr, grp, priv, n, n_label_pos, n_pred_pos, tp, fp, tn, fn,
  CASE WHEN n > 0 THEN n_pred_pos::DOUBLE / n ELSE 0.0 END AS selection_rate,
  CASE WHEN n > 0 THEN n_label_pos::DOUBLE / n ELSE 0.0 END AS base_rate,
  CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0.0 END AS tpr,
  CASE WHEN fp + tn > 0 THEN fp::DOUBLE / (fp + tn) ELSE 0.0 END AS fpr
FROM (SELECT attr, grp, bool_or(priv) AS priv, count(*)::BIGINT AS n,
        count_if(y = 1)::BIGINT AS n_label_pos, count_if(p = 1)::BIGINT AS n_pred_pos,
        count_if(y = 1 AND p = 1)::BIGINT AS tp, count_if(y = 0 AND p = 1)::BIGINT AS fp,
        count_if(y = 0 AND p = 0)::BIGINT AS tn, count_if(y = 1 AND p = 0)::BIGINT AS fn
      FROM ({tags}) t GROUP BY attr, grp) a"""


def _side_sql(groups: str, priv: bool, keys: str) -> str:
    return f"""
SELECT {keys}, n,
  CASE WHEN n > 0 THEN npp::DOUBLE / n ELSE 0.0 END AS sr,
  CASE WHEN n > 0 THEN nlp::DOUBLE / n ELSE 0.0 END AS br,
  CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0.0 END AS tpr,
  CASE WHEN fp + tn > 0 THEN fp::DOUBLE / (fp + tn) ELSE 0.0 END AS fpr
FROM (SELECT {keys}, sum(n)::BIGINT AS n, sum(n_pred_pos) AS npp, sum(n_label_pos) AS nlp,
        sum(tp) AS tp, sum(fn) AS fn, sum(fp) AS fp, sum(tn) AS tn
      FROM g WHERE priv = {str(priv).upper()} GROUP BY {keys}) x"""


def sql_metrics(b: dict, mode: str) -> str:
    if mode == "pooled":
        unpriv = f"SELECT *, '*' AS unpriv_group FROM ({_side_sql('g', False, 'attr')}) u0"
    else:
        unpriv = f"SELECT *, grp AS unpriv_group FROM ({_side_sql('g', False, 'attr, grp')}) u0"
    return f"""
WITH g AS ({sql_groups(b)}),
p AS ({_side_sql('g', True, 'attr')}),
u AS ({unpriv})
SELECT u.attr, u.unpriv_group, coalesce(p.n, 0)::BIGINT AS n_priv, u.n AS n_unpriv,
  p.sr AS sr_priv, u.sr AS sr_unpriv, p.tpr AS tpr_priv, u.tpr AS tpr_unpriv,
  p.fpr AS fpr_priv, u.fpr AS fpr_unpriv,
  u.sr - p.sr AS statistical_parity_difference,
  CASE WHEN p.sr IS NOT NULL AND p.sr <> 0 THEN u.sr / p.sr ELSE 0.0 END AS disparate_impact,
  u.tpr - p.tpr AS equal_opportunity_difference,
  ((u.tpr - p.tpr) + (u.fpr - p.fpr)) / 2 AS average_odds_difference,
  abs(u.sr - p.sr) AS demographic_parity,
  abs(u.br - p.br) AS dp_label
FROM u LEFT JOIN p ON u.attr = p.attr"""


def gates_values(dataset: str | None = None, with_dp: bool = False) -> str:
    rows = list(fz.DEFAULT_GATES) + ([fz.DEMOGRAPHIC_PARITY_GATE] if with_dp else [])
    if dataset:
        over = {m: (lo, hi) for d, m, lo, hi in fz.DATASET_GATES if d == dataset}
        rows = [(m, *over.get(m, (lo, hi))) for m, lo, hi in rows]
    vals = ", ".join(f"('{m}', {float(lo)}::DOUBLE, {float(hi)}::DOUBLE)" for m, lo, hi in rows)
    return f"(SELECT * FROM (VALUES {vals}) AS th(metric, lo, hi))"


def sql_gates(b: dict, mode: str, dataset: str | None = None, with_dp: bool = False) -> str:
    metrics = ", ".join(f"'{m}'" for m in fz.GATED_METRICS)
    return f"""
WITH m AS ({sql_metrics(b, mode)}),
l AS (UNPIVOT (SELECT attr, unpriv_group, statistical_parity_difference, disparate_impact,
                      equal_opportunity_difference, average_odds_difference, demographic_parity
               FROM m)
      ON {", ".join(m for m in fz.GATED_METRICS)} INTO NAME metric VALUE value)
SELECT l.attr, l.unpriv_group, l.metric, l.value, th.lo, th.hi,
  coalesce(l.value IS NOT NULL AND NOT isnan(l.value) AND l.value >= th.lo AND l.value <= th.hi,
           false) AS pass
FROM l JOIN {gates_values(dataset, with_dp)} th ON l.metric = th.metric
WHERE l.metric IN ({metrics})"""


def sql_verdict(gates_sql: str, keys: str = "attr") -> str:
    return f"""
SELECT {keys}, bool_and(pass) AS overall_pass,
  coalesce(string_agg(DISTINCT CASE WHEN NOT pass THEN metric END, ',' ORDER BY
           CASE WHEN NOT pass THEN metric END), '') AS failed_metrics,
  count_if(NOT pass)::BIGINT AS n_failed
FROM ({gates_sql}) gr GROUP BY {keys}"""


# ---------------------------------------------------------------- Spark side
def _lineitem(spark, sf):
    return T(spark, sf, "lineitem")


def _orders(spark, sf):
    return T(spark, sf, "orders")


def _docs(spark, sf):
    return T(spark, sf, "documents").join(T(spark, sf, "labels"), "doc_id")


ORACLE_GROUP_RATES = rnd(sql_groups(B.LI_SQL), RATES)


@register("fairness_group_rates", ORACLE_GROUP_RATES)
def fairness_group_rates(spark, sf):
    """A11 + A14: confusion counts and rates per (attribute, group)."""
    return fz.group_confusion(_lineitem(spark, sf), B.LI_ATTRS, B.LI_LABEL(), B.LI_PRED())


@register("fairness_metrics_pooled", rnd(sql_metrics(B.ORD_SQL, "pooled"), METRICS))
def fairness_metrics_pooled(spark, sf):
    """Parity metrics, unprivileged = all other values pooled."""
    return fz.fairness_metrics(_orders(spark, sf), B.ORD_ATTRS, B.ORD_LABEL(), B.ORD_PRED(), "pooled")


@register("fairness_metrics_pairwise", rnd(sql_metrics(B.ORD_SQL, "pairwise"), METRICS))
def fairness_metrics_pairwise(spark, sf):
    """F8: one row per unprivileged value against the privileged side."""
    return fz.fairness_metrics(_orders(spark, sf), B.ORD_ATTRS, B.ORD_LABEL(), B.ORD_PRED(),
                               "pairwise")


@register("fairness_multi_attr", rnd(sql_groups(B.ORD_SQL), RATES))
def fairness_multi_attr(spark, sf):
    """several protected attributes share one scan (generator + one aggregate)."""
    return fz.group_confusion(_orders(spark, sf), B.ORD_ATTRS, B.ORD_LABEL(), B.ORD_PRED())


def _ord_gates(spark, sf):
    m = fz.fairness_metrics(_orders(spark, sf), B.ORD_ATTRS, B.ORD_LABEL(), B.ORD_PRED(), "pairwise")
    return m, fz.apply_gates(m, fz.gate_table(spark))


@register("fairness_gates", rnd(sql_gates(B.ORD_SQL, "pairwise"), ["value", "lo", "hi"]))
def fairness_gates(spark, sf):
    """F10 + J5: metric rows joined with their bounds; NULL/NaN fails."""
    return _ord_gates(spark, sf)[1]


@register("fairness_verdict", sql_verdict(sql_gates(B.ORD_SQL, "pairwise")))
def fairness_verdict(spark, sf):
    """A22 + F16: per-attribute verdict and sorted failed-metric list."""
    return fz.verdict(_ord_gates(spark, sf)[1])


_SEV_SQL = f"""
WITH m AS ({sql_metrics(B.ORD_SQL, "pairwise")}),
v AS ({sql_verdict(sql_gates(B.ORD_SQL, "pairwise"), "attr, unpriv_group")})
SELECT m.attr, m.unpriv_group, m.disparate_impact, m.statistical_parity_difference, v.overall_pass,
  CASE WHEN m.disparate_impact < 0.5 OR m.disparate_impact > 2.0
            OR abs(m.statistical_parity_difference) > 0.3 THEN 'high'
       WHEN m.disparate_impact < 0.67 OR m.disparate_impact > 1.5
            OR abs(m.statistical_parity_difference) > 0.2 THEN 'medium'
       WHEN m.disparate_impact < 0.75 OR m.disparate_impact > 1.33
            OR abs(m.statistical_parity_difference) > 0.15 THEN 'low'
       WHEN NOT v.overall_pass THEN 'minor' ELSE 'none' END AS severity
FROM m JOIN v ON m.attr = v.attr AND m.unpriv_group = v.unpriv_group"""


@register("fairness_severity", rnd(_SEV_SQL, ["disparate_impact", "statistical_parity_difference"]))
def fairness_severity(spark, sf):
    """highest severity band exceeded."""
    m = fz.fairness_metrics(_orders(spark, sf), B.ORD_ATTRS, B.ORD_LABEL(), B.ORD_PRED(), "pairwise")
    return fz.severity(m, fz.gate_table(spark))


@register("fairness_dataset_thresholds",
          rnd(sql_gates(B.DOC_SQL, "pooled", "mimic", True), ["value", "lo", "hi"]))
def fairness_dataset_thresholds(spark, sf):
    """F14 + J6: stricter dataset bounds override defaults (imbalanced label)."""
    m = fz.fairness_metrics(_docs(spark, sf), B.DOC_ATTRS, B.DOC_LABEL(), B.DOC_PRED(), "pooled")
    return fz.apply_gates(m, fz.dataset_gates(spark, "mimic"))


@register("privileged_majority", """
WITH c AS (
  SELECT 'o_orderstatus' AS attr, CAST(o_orderstatus AS VARCHAR) AS grp, count(*)::BIGINT AS n
  FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 2
  UNION ALL
  SELECT 'o_orderpriority', CAST(o_orderpriority AS VARCHAR), count(*)::BIGINT
  FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 2)
SELECT attr, grp AS majority_group, n FROM (
  SELECT *, row_number() OVER (PARTITION BY attr ORDER BY n DESC, grp) AS rk FROM c) r
WHERE rk = 1""")
def privileged_majority(spark, sf):
    """A23 / F9 fallback: most frequent value per attribute, ties -> smallest."""
    return fz.majority_groups(_orders(spark, sf), ["o_orderstatus", "o_orderpriority"])


@register("privileged_threshold", rnd(sql_metrics(B.PART_SQL, "pairwise"), METRICS))
def privileged_threshold(spark, sf):
    """Numeric attribute, privileged when value >= 40."""
    return fz.fairness_metrics(T(spark, sf, "part"), B.PART_ATTRS, B.PART_LABEL(), B.PART_PRED(),
                               "pairwise")


@register("fairness_report_lines", f"""
SELECT attr, unpriv_group, metric,
  printf('%s [%s] %s: %.4f (%s)', attr, unpriv_group, metric, value,
         CASE WHEN pass THEN 'PASS' ELSE 'FAIL' END) AS line
FROM ({sql_gates(B.LI_SQL, "pooled")}) g""", rounded=False)
def fairness_report_lines(spark, sf):
    """report lines for the binary lineitem audit."""
    m = fz.fairness_metrics(_lineitem(spark, sf), B.LI_ATTRS, B.LI_LABEL(), B.LI_PRED(), "pooled")
    return fz.report_lines(m, fz.apply_gates(m, fz.gate_table(spark)))


@register("request_violations", """
SELECT event_type, count(*)::BIGINT AS n_requests,
  count_if(list_bool_or(list_transform(map_values(m), lambda x: x > 0.1)))::BIGINT AS n_violations
FROM (SELECT event_type,
        map_from_entries([('k', CAST(json_extract(props, '$.k') AS DOUBLE) / 500.0)]) AS m
      FROM events) e
GROUP BY event_type""")
def request_violations(spark, sf):
    """a request violates when any of its metric values exceeds 0.1
    (metric map parsed from the JSON request column, scaled by 1/500)."""
    ev = T(spark, sf, "events")
    m = F.transform_values(F.from_json("props", "map<string,double>"), lambda k, v: v / 500.0)
    flagged = fz.request_violations(ev.select("event_type", m.alias("m")), "m")
    return flagged.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_requests"),
                                             F.count_if("violation").alias("n_violations"))


@register("fairness_flagship", rnd(sql_gates(B.LI_SQL, "pooled"), ["value", "lo", "hi"]))
def fairness_flagship(spark, sf):
    """Phase-1 slice: lineitem binary audit -> gate rows (F6 + F10)."""
    m = fz.fairness_metrics(_lineitem(spark, sf), B.LI_ATTRS, B.LI_LABEL(), B.LI_PRED(), "pooled")
    return fz.apply_gates(m, fz.gate_table(spark))


def _detect_sql(table: str, col: str) -> str:
    cases, picks = [], []
    for i, (name, pats) in enumerate(fz.PRIVILEGED_PATTERNS):
        lst = ", ".join(f"'{p}'" for p in pats)
        picks.append(f"(SELECT string_agg(v, ',' ORDER BY v) FROM vals WHERE v IN ({lst})) AS m{i}")
        cases.append((f"m{i}", name))
    priv = "CASE " + " ".join(f"WHEN {m} IS NOT NULL THEN {m}" for m, _ in cases) + " ELSE maj END"
    rule = "CASE " + " ".join(f"WHEN {m} IS NOT NULL THEN '{n}'" for m, n in cases) + \
        " ELSE 'majority' END"
    return f"""
WITH vals AS (SELECT CAST({col} AS VARCHAR) AS v, count(*) AS n FROM {table}
              WHERE {col} IS NOT NULL GROUP BY 1),
p AS (SELECT {", ".join(picks)},
        (SELECT v FROM vals ORDER BY n DESC, v LIMIT 1) AS maj)
SELECT '{col}' AS attr, {priv} AS privileged, {rule} AS rule FROM p"""


@register("privileged_detect", "SELECT * FROM (" + _detect_sql("orders", "o_orderstatus") +
          ") a\nUNION ALL\nSELECT * FROM (" + _detect_sql("documents", "lang") + ") b")
def privileged_detect(spark, sf):
    """privileged values by fixed value patterns, else the majority value
    (status 'F' matches a pattern list; lang falls back to the majority)."""
    a = fz.detect_privileged(_orders(spark, sf), "o_orderstatus")
    b = fz.detect_privileged(T(spark, sf, "documents"), "lang")
    return a.unionByName(b).select("attr", F.concat_ws(",", "privileged").alias("privileged"),
                                   "rule")


_NAMED_ATTRS = [fz.Protected("o_orderpriority", privileged=["1-URGENT"],
                             unprivileged=["4-NOT SPECIFIED", "5-LOW"])]
_NAMED_SQL = dict(attrs=[("o_orderpriority", "CAST(o_orderpriority AS VARCHAR)",
                          "o_orderpriority IN ('1-URGENT')")],
                  label=B.ORD_SQL["label"], pred=B.ORD_SQL["pred"],
                  source="(SELECT * FROM orders WHERE o_orderpriority IN "
                         "('1-URGENT', '4-NOT SPECIFIED', '5-LOW'))")


@register("fairness_named_groups", rnd(sql_metrics(_NAMED_SQL, "pooled"), METRICS))
def fairness_named_groups(spark, sf):
    """Named privileged and unprivileged lists; other values are left out."""
    return fz.fairness_metrics(_orders(spark, sf), _NAMED_ATTRS, B.ORD_LABEL(), B.ORD_PRED(),
                               "pooled")
