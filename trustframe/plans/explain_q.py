"""Attribution queries (E1-E8, A20, W5, W6) for the fixed linear scorer on
lineitem, plus model-agnostic sampled Shapley / LIME on orders and
documents (no SQL oracle: checked by closed cases in tests)."""

from __future__ import annotations

from pyspark.sql import functions as F

from trustframe.operators import explain as ex
from trustframe.operators import sampling as sm
from trustframe.plans.metrics_q import LI_B, LI_COEF
from trustframe.plans.registry import T, register, rnd
from trustframe.sources.tables import deal_small

_KEEP = ["l_orderkey", "l_linenumber", "l_linestatus"]


def local(spark, sf):
    li = T(spark, sf, "lineitem")
    return ex.linear_shap(li, LI_COEF, _KEEP)


def _means_sql() -> str:
    return "(SELECT " + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}" for c in LI_COEF) + " FROM lineitem)"


LOCAL_SQL = "\nUNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, l_linestatus, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, "
    f"({b}) * (CAST({c} AS DOUBLE) - m_{c}) AS shap FROM lineitem, {_means_sql()} m"
    for c, b in LI_COEF.items())

GLOBAL_SQL = f"""
SELECT feature, importance, mean_shap, row_number() OVER (ORDER BY importance DESC, feature) AS rank
FROM (SELECT feature, avg(abs(shap)) AS importance, avg(shap) AS mean_shap FROM ({LOCAL_SQL}) l
      GROUP BY feature) g"""


@register("shap_linear_local", rnd(LOCAL_SQL, ["value", "shap"]))
def shap_linear_local(spark, sf):
    """Exact per-row attributions of a linear scorer (margin space)."""
    return local(spark, sf)


@register("shap_linear_global", rnd(f"SELECT feature, importance, mean_shap, CAST(rank AS INTEGER) AS rank "
                                    f"FROM ({GLOBAL_SQL}) g", ["importance", "mean_shap"]))
def shap_linear_global(spark, sf):
    """E1 + A20 + W5: mean |phi| per feature, ranked."""
    return ex.global_importance(local(spark, sf))


@register("shap_by_group", rnd(f"""
SELECT l_linestatus AS grp, feature, count(*)::BIGINT AS n, avg(shap) AS mean_shap,
  avg(abs(shap)) AS mean_abs_shap FROM ({LOCAL_SQL}) l GROUP BY 1, 2""", ["mean_shap", "mean_abs_shap"]))
def shap_by_group(spark, sf):
    """Attributions per protected group, over the whole group."""
    return ex.by_group(local(spark, sf), "l_linestatus")


@register("explain_overview", rnd(f"""
WITH l AS ({LOCAL_SQL}), t AS (SELECT feature, avg(abs(shap)) AS importance_all FROM l GROUP BY feature),
x AS (SELECT 'group' AS scope, l_linestatus AS grp, feature, count(*)::BIGINT AS n, avg(shap) AS mean_shap, avg(abs(shap)) AS importance
      FROM l GROUP BY 2, 3
      UNION ALL SELECT 'all', NULL, feature, count(*)::BIGINT, avg(shap), avg(abs(shap)) FROM l GROUP BY 3),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY scope, grp ORDER BY importance DESC, feature) AS INTEGER) AS rank FROM x)
SELECT r.*, importance_all FROM r JOIN t USING (feature) WHERE rank <= 10""", ["mean_shap", "importance", "importance_all"]))
def explain_overview(spark, sf):
    """Top features over all rows and per group, from one aggregation of the local attributions."""
    return ex.overview(local(spark, sf), "l_linestatus")


@register("topk_features", rnd(f"SELECT feature, importance, mean_shap, CAST(rank AS INTEGER) AS rank "
                               f"FROM ({GLOBAL_SQL}) g WHERE rank <= 3", ["importance", "mean_shap"]))
def topk_features(spark, sf):
    """Top-3 features (a top-k report)."""
    return ex.top_features(ex.global_importance(local(spark, sf)), 3)


@register("explain_report_lines", f"""
SELECT CAST(rank AS INTEGER) AS rank, printf('%d. %s: %.4f', rank, feature, importance) AS line
FROM ({GLOBAL_SQL}) g WHERE rank <= 10""", rounded=False)
def explain_report_lines(spark, sf):
    """Report lines for the top 10 features."""
    return ex.report_lines(ex.global_importance(local(spark, sf)), 10)


_F_SQL = f"({LI_B} + " + " + ".join(f"({b}) * CAST({c} AS DOUBLE)" for c, b in LI_COEF.items()) + ")"
_S_SQL = "(" + " + ".join(f"({b}) * (CAST({c} AS DOUBLE) - m_{c})" for c, b in LI_COEF.items()) + ")"
_EF_SQL = f"({LI_B} + " + " + ".join(f"({b}) * m_{c}" for c, b in LI_COEF.items()) + ")"


@register("shap_additivity", rnd(f"""
SELECT max(abs({_S_SQL} - ({_F_SQL} - {_EF_SQL}))) AS max_error, count(*)::BIGINT AS n_rows
FROM lineitem, {_means_sql()} m""", ["max_error"]))
def shap_additivity(spark, sf):
    """Property: attributions add up to f(x) - E f(x) on every row."""
    li = T(spark, sf, "lineitem")
    return ex.additivity_error(li, LI_COEF, LI_B, ex.feature_means(li, list(LI_COEF)))


# ------------------------------------------------------------- model-agnostic
ORD_FEATS = ["o_totalprice", "o_custkey", "o_days"]
ORD_COEF = {"o_totalprice": 1e-5, "o_custkey": -2e-4, "o_days": 1e-3}


def _orders_x(spark, sf):
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double"),
                    F.col("o_custkey").cast("double"),
                    F.datediff(F.col("o_orderdate"), F.lit("1992-01-01")).cast("double").alias("o_days"))


def ord_scorer(cols):
    m = F.lit(-2.0)
    for c, b in ORD_COEF.items():
        m = m + F.lit(b) * cols[c]
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-m))


def _u_sql(*args: str) -> str:
    return ("((('0x' || substr(md5(concat_ws(':', " + ", ".join(args) +
            ")), 1, 13))::BIGINT)::DOUBLE / 4503599627370496.0)")


def _shapley_sql(n_perm: int = 16, seed: int = 42, bg_seed: int = 7, nbg: int = 100) -> str:
    f = ORD_FEATS

    def score(vals):
        m = " + ".join(f"({ORD_COEF[c]}) * {vals[c]}" for c in f)
        return f"(1.0 / (1.0 + exp(-(-2.0 + {m}))))"
    parts = []
    for j in f:
        w, wo = {}, {}
        for c in f:
            if c == j:
                w[c], wo[c] = f"x_{c}", f"z_{c}"
            else:
                w[c] = wo[c] = f"(CASE WHEN k_{c} < k_{j} THEN x_{c} ELSE z_{c} END)"
        parts.append(f"SELECT id, '{j}' AS feature, {score(w)} - {score(wo)} AS d FROM j")
    keys = ", ".join(f"{_u_sql(str(seed), 'id', 'm', repr(c))} AS k_{c}" for c in f)
    return f"""
WITH x AS (SELECT o_orderkey AS id, CAST(o_totalprice AS DOUBLE) AS x_o_totalprice,
             CAST(o_custkey AS DOUBLE) AS x_o_custkey,
             CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS x_o_days
           FROM orders),
bg0 AS (SELECT * FROM x ORDER BY md5('{bg_seed}:' || CAST(id AS VARCHAR)), id LIMIT {nbg}),
bg AS (SELECT x_o_totalprice AS z_o_totalprice, x_o_custkey AS z_o_custkey, x_o_days AS z_o_days,
         row_number() OVER (ORDER BY x_o_totalprice, x_o_custkey, x_o_days) - 1 AS bi FROM bg0),
nb AS (SELECT count(*) AS nb FROM bg),
p AS (SELECT x.*, r.m, CAST(floor({_u_sql(str(seed), "'bg'", 'id', 'r.m')} * nb.nb) AS BIGINT) AS bi
      FROM x, range(0, {n_perm}) r(m), nb),
j AS (SELECT p.*, bg.z_o_totalprice, bg.z_o_custkey, bg.z_o_days, {keys} FROM p JOIN bg USING (bi))
SELECT id AS o_orderkey, feature, avg(d) AS shap FROM ({" UNION ALL ".join(parts)}) t
GROUP BY id, feature"""


@register("shapley_sampled", rnd(_shapley_sql(), ["shap"]))
def shapley_sampled(spark, sf):
    """Permutation-sampled Shapley values of a (non-linear) probability
    scorer for every order, 16 permutations, 100-row seeded background."""
    x = _orders_x(spark, sf)
    bg = sm.sample_per_group(x, None, "o_orderkey", 100, seed=7)
    return ex.sampled_shapley(deal_small(x), bg.select(*ORD_FEATS), "o_orderkey", ORD_FEATS, ord_scorer, 16)


LIME_SCALES = {"o_totalprice": 100000.0, "o_custkey": 1000.0, "o_days": 500.0}


def _lime_tabular_sql(n_samples: int = 200, seed: int = 42) -> str:
    f = ORD_FEATS
    kw2 = repr((0.75 * len(f) ** 0.5) ** 2)
    eps = ", ".join(
        f"sqrt(-2.0 * ln(greatest({_u_sql(str(seed), 's', repr(c), repr('a'))}, 1e-12))) * "
        f"cos(6.283185307179586::DOUBLE * {_u_sql(str(seed), 's', repr(c), repr('b'))}) AS e_{c}"
        for c in f)
    z = {c: f"(x_{c} + ({LIME_SCALES[c]}) * e_{c})" for c in f}
    margin = "-2.0" + "".join(f" + ({ORD_COEF[c]}) * {z[c]}" for c in f)
    d2 = " + ".join(f"e_{c} * e_{c}" for c in f)
    sums = ", ".join([f"sum(w * e_{c}) AS s_{c}" for c in f] +
                     [f"sum(w * e_{a} * e_{b}) AS s_{a}_{b}" for i, a in enumerate(f) for b in f[i:]] +
                     [f"sum(w * e_{c} * fv) AS r_{c}" for c in f])
    c1, c2, c3 = f
    cov = lambda a, b: f"(s_{a}_{b} - sw * m_{a} * m_{b})"
    rr = lambda a: f"(r_{a} - sw * m_{a} * mf)"
    A, B, C, D, E, G = cov(c1, c1), cov(c1, c2), cov(c1, c3), cov(c2, c2), cov(c2, c3), cov(c3, c3)
    return f"""
WITH x AS (SELECT o_orderkey AS id, CAST(o_totalprice AS DOUBLE) AS x_o_totalprice,
             CAST(o_custkey AS DOUBLE) AS x_o_custkey,
             CAST(date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS x_o_days
           FROM orders),
ep AS (SELECT s, {eps} FROM range(0, {n_samples}) r(s)),
e AS (SELECT x.*, ep.* FROM x, ep),
g AS (SELECT id, {", ".join(f"e_{c}" for c in f)}, 1.0 / (1.0 + exp(-({margin}))) AS fv,
        exp(-({d2}) / {kw2}) AS w FROM e),
a AS (SELECT id, sum(w) AS sw, sum(w * fv) AS sf, {sums} FROM g GROUP BY id),
m AS (SELECT *, s_{c1} / sw AS m_{c1}, s_{c2} / sw AS m_{c2}, s_{c3} / sw AS m_{c3}, sf / sw AS mf FROM a),
k AS (SELECT *, {A} AS ca, {B} AS cb, {C} AS cc, {D} AS cd, {E} AS ce, {G} AS cg,
        {rr(c1)} AS b1, {rr(c2)} AS b2, {rr(c3)} AS b3 FROM m),
v AS (SELECT *, ca * (cd * cg - ce * ce) - cb * (cb * cg - cc * ce) + cc * (cb * ce - cc * cd) AS det FROM k),
sol AS (SELECT id, mf, m_{c1}, m_{c2}, m_{c3},
  ((cd * cg - ce * ce) * b1 + (cc * ce - cb * cg) * b2 + (cb * ce - cc * cd) * b3) / det AS w1,
  ((cc * ce - cb * cg) * b1 + (ca * cg - cc * cc) * b2 + (cb * cc - ca * ce) * b3) / det AS w2,
  ((cb * ce - cc * cd) * b1 + (cb * cc - ca * ce) * b2 + (ca * cd - cb * cb) * b3) / det AS w3 FROM v),
out AS (SELECT id, w1, w2, w3, mf - w1 * m_{c1} - w2 * m_{c2} - w3 * m_{c3} AS intercept FROM sol)
SELECT id AS o_orderkey, '{c1}' AS feature, w1 AS weight, intercept FROM out
UNION ALL SELECT id, '{c2}', w2, intercept FROM out
UNION ALL SELECT id, '{c3}', w3, intercept FROM out"""


@register("lime_tabular", rnd(_lime_tabular_sql(), ["weight", "intercept"]))
def lime_tabular(spark, sf):
    """Local linear surrogate per order (200 seeded perturbations)."""
    x = _orders_x(spark, sf)
    return ex.lime_tabular(deal_small(x), "o_orderkey", ORD_FEATS, ord_scorer, LIME_SCALES)


# A small bag-of-words scorer for the text explainer.
TEXT_WORDS = {"the": 0.2, "der": 0.2, "le": 0.2, "el": 0.2, "and": 0.1}


def _is(word):
    return lambda t: t == F.lit(word)


def in_scorer(word):
    """The words that ``text_scorer`` looks at."""
    return word.isin(*TEXT_WORDS)


def text_scorer(tokens):
    def margin(known):
        s = F.lit(-1.0)
        for w, b in TEXT_WORDS.items():
            s = s + F.lit(b) * F.size(F.filter(known, _is(w)))
        return s
    # one pass over all words, the others over the few that count
    s = F.get(F.transform(F.array(F.filter(tokens, in_scorer)), margin), F.lit(0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-s))


def _lime_text_sql(n_samples: int = 64, seed: int = 42) -> str:
    score = " + ".join(f"({b}) * coalesce(sum(c) FILTER (kept AND word = '{w}'), 0)" for w, b in TEXT_WORDS.items())
    digest = f"md5('{seed}:' || id || ':' || word || ':' || (blk // 4))"
    return f"""
WITH d AS (SELECT doc_id AS id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}'']+'),
             lambda x: x <> '') AS t FROM documents),
tok AS (SELECT id, word, count(*) AS c FROM (SELECT id, unnest(t) AS word FROM d) GROUP BY id, word),
m AS (SELECT id, word, c, blk, ('0x' || substr({digest}, 1 + 8 * (blk % 4), 8))::BIGINT AS bits
      FROM tok, range(0, {-(-n_samples // 32)}) r(blk)),
k AS (SELECT id, word, c, s, ((bits >> (s % 32)) & 1) = 1 AS kept FROM m JOIN range(0, {n_samples}) r(s) ON s // 32 = blk),
f AS (SELECT id, s, 1.0 / (1.0 + exp(-(-1.0 + {score}))) AS f FROM k GROUP BY id, s)
SELECT k.id AS doc_id, k.word,
  avg(CASE WHEN k.kept THEN f.f END) - avg(CASE WHEN NOT k.kept THEN f.f END) AS weight,
  count_if(k.kept)::BIGINT AS n_kept, count_if(NOT k.kept)::BIGINT AS n_dropped
FROM k JOIN f ON k.id = f.id AND k.s = f.s GROUP BY k.id, k.word"""


@register("lime_text", rnd(_lime_text_sql(), ["weight"]))
def lime_text(spark, sf):
    """E5 + E9: word importance for every document (whole text, 64 masks)."""
    d = T(spark, sf, "documents").select("doc_id", "text")
    return ex.lime_text(deal_small(d), "doc_id", "text", text_scorer, counts=in_scorer)
