"""Cleaning and validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from trustframe.functions.exprs import label_map, right_closed_bins
from trustframe.operators import clean, validate
from trustframe.operators.stats import column_modes, exact_medians
from trustframe.plans.registry import T, register, rnd

# lineitem with injected missing values: discount 0 -> NULL, returnflag N -> NULL
MISSING_SQL = """(SELECT l_orderkey, l_linenumber, l_quantity, nullif(l_discount, 0.0) AS l_discount,
  l_tax, nullif(l_returnflag, 'N') AS l_returnflag, l_linestatus FROM lineitem)"""


def missing_frame(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity",
                     F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), "l_tax",
                     F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"), "l_linestatus")


SPARSE_SQL = """(SELECT l_orderkey, l_linenumber, nullif(l_discount, 0.0) AS l_discount,
  nullif(l_returnflag, 'N') AS l_returnflag, nullif(l_tax, 0.0) AS l_tax,
  nullif(l_linestatus, 'O') AS l_linestatus,
  CASE WHEN l_quantity > 25 THEN l_quantity END AS l_quantity FROM lineitem)"""


def sparse_frame(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
                     F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"),
                     F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
                     F.nullif("l_linestatus", F.lit("O")).alias("l_linestatus"),
                     F.when(F.col("l_quantity") > 25, F.col("l_quantity")).alias("l_quantity"))


@register("sentinel_to_null", """
SELECT l_orderkey, l_linenumber,
  nullif(ltrim(CASE WHEN l_returnflag = 'N' THEN '?' ELSE l_returnflag END), '?') AS l_returnflag,
  nullif(ltrim(l_linestatus), '?') AS l_linestatus
FROM lineitem""")
def sentinel_to_null(spark, sf):
    """Sentinel '?' (written for returnflag N) becomes NULL in string columns."""
    li = T(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "N", F.lit("?")).otherwise(F.col("l_returnflag"))
        .alias("l_returnflag"), "l_linestatus")
    return clean.sentinel_to_null(li, "?")


@register("label_map", """
SELECT o_orderkey, o_orderstatus,
  CAST(CASE WHEN o_orderstatus = 'F' THEN 1 WHEN o_orderstatus = 'O' THEN 0 END AS INTEGER) AS label
FROM orders""")
def label_map_q(spark, sf):
    """Listed labels to 1/0, anything else NULL."""
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", "o_orderstatus",
                    label_map(F.col("o_orderstatus"), {"F": 1, "O": 0}).alias("label"))


@register("right_closed_bins", """
SELECT bin, count(*)::BIGINT AS n, min(l_quantity) AS min_q, max(l_quantity) AS max_q FROM (
  SELECT l_quantity, CASE WHEN l_quantity > 0 AND l_quantity <= 30 THEN '<30'
    WHEN l_quantity > 30 AND l_quantity <= 40 THEN '30-40'
    WHEN l_quantity > 40 AND l_quantity <= 50 THEN '40-50'
    WHEN l_quantity > 50 AND l_quantity <= 100 THEN '50+' END AS bin FROM lineitem) b
GROUP BY bin""")
def right_closed_bins_q(spark, sf):
    """P5: (0,30],(30,40],(40,50],(50,100]; exact 30/40/50 fall in the lower bin."""
    li = T(spark, sf, "lineitem")
    b = li.select("l_quantity", right_closed_bins(F.col("l_quantity"), clean.AGE_EDGES,
                                                  clean.AGE_LABELS).alias("bin"))
    return b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.min("l_quantity").alias("min_q"),
                                F.max("l_quantity").alias("max_q"))


@register("drop_sparse_rows", f"""
SELECT * FROM {SPARSE_SQL} s
WHERE (CASE WHEN l_orderkey IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN l_linenumber IS NOT NULL THEN 1 ELSE 0 END
     + CASE WHEN l_discount IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN l_returnflag IS NOT NULL THEN 1 ELSE 0 END
     + CASE WHEN l_tax IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN l_linestatus IS NOT NULL THEN 1 ELSE 0 END
     + CASE WHEN l_quantity IS NOT NULL THEN 1 ELSE 0 END) >= 4""")
def drop_sparse_rows(spark, sf):
    """Keep rows with at least int(0.7 * 7) = 4 values."""
    return clean.drop_sparse_rows(sparse_frame(spark, sf), 0.7)


_FT_COLS = ["l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
            "l_extendedprice"]


def _ft_sql():
    parts = []
    for c in _FT_COLS:
        if c in ("l_returnflag", "l_linestatus"):
            parts.append(f"SELECT '{c}' AS feature, 'string' AS dtype, "
                         f"CASE WHEN count(DISTINCT {c}) <= 10 THEN count(DISTINCT {c}) END::BIGINT "
                         f"AS n_distinct, 'categorical' AS kind FROM lineitem")
        else:
            parts.append(f"SELECT '{c}' AS feature, 'numeric' AS dtype, CASE WHEN "
                         f"count(DISTINCT {c}) <= 10 THEN count(DISTINCT {c}) END::BIGINT AS "
                         f"n_distinct, CASE WHEN count(DISTINCT {c}) <= 10 AND "
                         f"count(DISTINCT {c}) < 0.05 * count(*) THEN 'categorical' ELSE 'numerical' "
                         f"END AS kind FROM lineitem")
    return "\nUNION ALL ".join(parts)


@register("feature_types", _ft_sql())
def feature_types(spark, sf):
    """P8 + A7: categorical vs numerical by type and exact distinct count."""
    return clean.feature_types(T(spark, sf, "lineitem").select(*_FT_COLS))


@register("missing_profile", rnd(f"""
SELECT feature, n_missing::BIGINT AS n_missing, n_missing / n AS missing_frac FROM (
  UNPIVOT (SELECT count(*) AS n,
      count_if(l_orderkey IS NULL) AS l_orderkey, count_if(l_linenumber IS NULL) AS l_linenumber,
      count_if(l_quantity IS NULL OR isnan(l_quantity)) AS l_quantity,
      count_if(l_discount IS NULL OR isnan(l_discount)) AS l_discount,
      count_if(l_tax IS NULL OR isnan(l_tax)) AS l_tax,
      count_if(l_returnflag IS NULL) AS l_returnflag, count_if(l_linestatus IS NULL) AS l_linestatus
    FROM {MISSING_SQL} m)
  ON COLUMNS(* EXCLUDE (n)) INTO NAME feature VALUE n_missing) u""", ["missing_frac"]))
def missing_profile(spark, sf):
    """A3: missing count and share per column (one aggregate)."""
    return clean.missing_profile(missing_frame(spark, sf))


@register("class_distribution", rnd("""
SELECT o_orderstatus AS label, count(*)::BIGINT AS n, count(*) / sum(count(*)) OVER () AS share
FROM orders GROUP BY o_orderstatus""", ["share"]))
def class_distribution(spark, sf):
    """A1: class counts and shares."""
    return validate.class_distribution(T(spark, sf, "orders"), "o_orderstatus")


@register("validation_report", rnd(f"""
WITH m AS {MISSING_SQL},
c AS (SELECT l_linestatus, count(*) AS n FROM m GROUP BY 1),
p AS (SELECT avg(f) AS mean_missing, count_if(f > 0.5)::BIGINT AS n_high_missing,
        coalesce(string_agg(CASE WHEN f > 0.5 THEN k END, ',' ORDER BY k), '') AS high_missing FROM (
        SELECT 'l_orderkey' k, avg(CASE WHEN l_orderkey IS NULL THEN 1.0 ELSE 0.0 END) f FROM m
        UNION ALL SELECT 'l_linenumber', avg(CASE WHEN l_linenumber IS NULL THEN 1.0 ELSE 0.0 END) FROM m
        UNION ALL SELECT 'l_quantity', avg(CASE WHEN l_quantity IS NULL THEN 1.0 ELSE 0.0 END) FROM m
        UNION ALL SELECT 'l_discount', avg(CASE WHEN l_discount IS NULL THEN 1.0 ELSE 0.0 END) FROM m
        UNION ALL SELECT 'l_tax', avg(CASE WHEN l_tax IS NULL THEN 1.0 ELSE 0.0 END) FROM m
        UNION ALL SELECT 'l_returnflag', avg(CASE WHEN l_returnflag IS NULL THEN 1.0 ELSE 0.0 END) FROM m) x)
SELECT (SELECT sum(n) FROM c)::BIGINT AS n_rows, 6 AS n_features, 'gender' AS missing_protected,
  (SELECT min(n) FROM c)::BIGINT AS min_class, (SELECT max(n) FROM c)::BIGINT AS max_class,
  (SELECT min(n) FROM c) / (SELECT max(n) FROM c) AS class_ratio,
  (SELECT min(n) FROM c) / (SELECT max(n) FROM c) < 0.1 AS imbalance_warning,
  p.mean_missing, p.n_high_missing, p.high_missing, (SELECT sum(n) FROM c) = 0 AS empty
FROM p""", ["class_ratio", "mean_missing"]))
def validation_report(spark, sf):
    """A2 + A4: one-row validation report (label l_linestatus)."""
    return validate.validation_report(missing_frame(spark, sf), "l_linestatus",
                                      ["l_returnflag", "gender"])


_MODE_SQL = """(SELECT v FROM (SELECT l_returnflag AS v, count(*) AS n FROM m
  WHERE l_returnflag IS NOT NULL GROUP BY 1) t ORDER BY n DESC, v LIMIT 1)"""


@register("impute_values", rnd(f"""
WITH m AS {MISSING_SQL}
SELECT 'l_discount' AS feature, median(l_discount) AS fill_num, NULL::VARCHAR AS fill_str FROM m
UNION ALL SELECT 'l_quantity', median(l_quantity), NULL FROM m
UNION ALL SELECT 'l_returnflag', NULL::DOUBLE, {_MODE_SQL}""", ["fill_num"]))
def impute_values(spark, sf):
    """A5 + A6: exact median (numeric) and mode (string, ties smallest)."""
    return clean.impute_values(missing_frame(spark, sf), ["l_discount", "l_quantity"],
                               ["l_returnflag"])


@register("impute_median_mode", rnd(f"""
WITH m AS {MISSING_SQL}
SELECT l_orderkey, l_linenumber, l_quantity,
  coalesce(l_discount, (SELECT median(l_discount) FROM m)) AS l_discount, l_tax,
  coalesce(l_returnflag, {_MODE_SQL}) AS l_returnflag, l_linestatus FROM m""",
    ["l_quantity", "l_discount", "l_tax"]))
def impute_median_mode(spark, sf):
    """Fill numeric NULLs with the median and strings with the mode."""
    return clean.impute(missing_frame(spark, sf))


@register("column_medians", rnd("""
SELECT 'o_totalprice' AS feature, median(o_totalprice) AS median FROM orders
UNION ALL SELECT 'o_custkey', median(o_custkey) FROM orders""", ["median"]))
def column_medians(spark, sf):
    """A5 at full resolution: exact median of a continuous column without a
    whole-column sort (bracketed by approximate quantiles)."""
    return exact_medians(T(spark, sf, "orders"), ["o_totalprice", "o_custkey"])


@register("column_modes", """
SELECT feature, mode FROM (
  SELECT feature, v AS mode, row_number() OVER (PARTITION BY feature ORDER BY n DESC, v) AS r FROM (
    SELECT 'c_mktsegment' AS feature, c_mktsegment AS v, count(*) AS n FROM customer GROUP BY 2
    UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*) FROM customer GROUP BY 2) a) b
WHERE r = 1""")
def column_modes_q(spark, sf):
    """Mode per column (ties -> smallest value as text)."""
    return column_modes(T(spark, sf, "customer"), ["c_mktsegment", "c_nationkey"])


@register("distinct_values", """
SELECT DISTINCT o_orderpriority FROM orders""")
def distinct_values(spark, sf):
    """Distinct values of a column."""
    return T(spark, sf, "orders").select("o_orderpriority").distinct()
