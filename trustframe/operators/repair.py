"""Disparate-impact repair of a numeric feature (M10): every value is
replaced by the median, over groups, of the groups' quantile functions at
the value's own within-group quantile (full repair), on a grid of G
quantiles.

Quantiles come from per-group value histograms and the distributed prefix
sum (H1); each histogram row expands only to the grid points it covers, so
the quantile table has exactly G rows per group whatever the data size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustframe.functions.exprs import nan_to_null
from trustframe.functions.joins import MAX_BROADCAST_ROWS, materialize_small
from trustframe.operators.ranking import prefix_counts
from trustframe.session import cut_lineage


def quantile_repair(df: DataFrame, value: str, group: str, grid: int = 100,
                    out: str = "repaired", rows_per_bucket: int = 100_000) -> DataFrame:
    g = int(grid)
    src = df.select("*", F.col(group).cast("string").alias("__g"),
                    nan_to_null(F.col(value).cast("double")).alias("__v"))
    h = src.where(F.col("__v").isNotNull() & F.col("__g").isNotNull()) \
        .groupBy("__g", "__v").agg(F.count(F.lit(1)).alias("c"))
    h = cut_lineage(h)  # per-group value histogram, read by several jobs
    cum = prefix_counts(h, "__g", "__v", ["c"], rows_per_bucket, materialized=True)
    tot, small = materialize_small(h.groupBy("__g").agg(F.sum("c").alias("__n")))
    cum = cum.join(F.broadcast(tot) if small else tot, "__g")
    cum = cum.select("__g", "__v",
                     F.expr(f"(cum_c - c) * {g} div __n + 1").alias("__lo"),
                     F.expr(f"cum_c * {g} div __n").alias("__hi"),
                     F.expr(f"((cum_c - c) * {g} + __n - 1) div __n").alias("__clo"),
                     F.expr(f"(cum_c * {g} + __n - 1) div __n - 1").alias("__chi"))
    q = cum.where(F.col("__lo") <= F.col("__hi")).select(
        "__v", F.explode(F.sequence("__lo", "__hi")).alias("__i"))
    # grid x groups rows; the median runs over one value per group
    target = {r["__i"]: r["m"] for r in q.groupBy("__i").agg(F.median("__v").alias("m")).collect()}
    # a value's cell is 1 + the number of cut points up to it: the i-th is the
    # smallest value with more than i/g of the group up to it. Both ends travel
    # with the rows (grid numbers per group), so rows are not shuffled by value
    cuts = cum.where(F.col("__clo") <= F.col("__chi")) \
        .select("__g", "__v", F.explode(F.sequence("__clo", "__chi")).alias("__i")).where("__i >= 1") \
        .groupBy("__g").agg(F.array_sort(F.collect_list("__v")).alias("__cuts"))
    cuts = tot.select("__g").join(cuts, "__g", "left")
    cuts, small = materialize_small(cuts, MAX_BROADCAST_ROWS // g)
    j = src.join(F.broadcast(cuts) if small else cuts, "__g", "left")
    cell = F.size(F.filter(F.coalesce("__cuts", F.array().cast("array<double>")), lambda x: x <= F.col("__v"))) + 1
    goal = F.array(*[F.lit(target.get(i)).cast("double") for i in range(1, g + 1)])
    ok = F.col("__g").isNotNull() & F.col("__v").isNotNull()
    return j.withColumn(out, F.when(ok, F.element_at(goal, cell))).drop("__g", "__v", "__cuts")
