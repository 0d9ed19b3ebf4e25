"""How the provided test tables play the reference's roles (FIXTURES.md §3).

Each binding gives the Spark expression and the same expression in SQL so
that the query and its oracle cannot drift apart."""

from __future__ import annotations

from pyspark.sql import functions as F

from trustframe.operators.fairness import Protected

# lineitem, binary group: l_linestatus (privileged O), label returnflag R,
# prediction discount >= 0.05
LI_ATTRS = [Protected("l_linestatus", privileged=["O"])]
def LI_LABEL():
    return F.col("l_returnflag") == "R"


def LI_PRED():
    return F.col("l_discount") >= 0.05


LI_SQL = dict(attrs=[("l_linestatus", "CAST(l_linestatus AS VARCHAR)", "l_linestatus IN ('O')")],
              label="l_returnflag = 'R'", pred="l_discount >= 0.05", source="lineitem")

# orders, several attributes; the prediction uses a lower price cut for
# status P, so the gates for o_orderstatus must fail.
ORD_ATTRS = [Protected("o_orderstatus", privileged=["F"]),
             Protected("o_orderpriority", privileged=["1-URGENT", "2-HIGH"])]
def ORD_LABEL():
    return F.col("o_totalprice") > 250000.0


def ORD_PRED():
    return F.col("o_totalprice") > F.when(F.col("o_orderstatus") == "P", F.lit(150000.0)) \
        .otherwise(F.lit(250000.0))


ORD_SQL = dict(attrs=[("o_orderstatus", "CAST(o_orderstatus AS VARCHAR)", "o_orderstatus IN ('F')"),
                      ("o_orderpriority", "CAST(o_orderpriority AS VARCHAR)",
                       "o_orderpriority IN ('1-URGENT', '2-HIGH')")],
               label="o_totalprice > 250000.0",
               pred="o_totalprice > CASE WHEN o_orderstatus = 'P' THEN 150000.0 ELSE 250000.0 END",
               source="orders")

# documents joined with labels: group lang (privileged en), imbalanced label
# quality, prediction n_chars > 1000
DOC_ATTRS = [Protected("lang", privileged=["en"])]
def DOC_LABEL():
    return F.col("quality") == 1


def DOC_PRED():
    return F.col("n_chars") > 1000


DOC_SQL = dict(attrs=[("lang", "CAST(lang AS VARCHAR)", "lang IN ('en')")],
               label="quality = 1", pred="n_chars > 1000",
               source="(SELECT d.*, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id))")

# part, privileged by threshold: p_size >= 40; label retail price above 950,
# prediction brand number <= 12
PART_ATTRS = [Protected("p_size", threshold=40)]
def PART_LABEL():
    return F.col("p_retailprice") > 950.0


def PART_PRED():
    return F.substring_index(F.col("p_brand"), "#", -1).cast("int") <= 12


PART_SQL = dict(attrs=[("p_size", "CASE WHEN p_size >= 40 THEN '>=40' WHEN p_size IS NOT NULL "
                                  "THEN '<40' END", "p_size >= 40")],
                label="p_retailprice > 950.0",
                pred="CAST(split_part(p_brand, '#', 2) AS INTEGER) <= 12", source="part")
