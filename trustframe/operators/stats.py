"""Exact column statistics that stay distributed.

``exact_medians`` never sorts or collects a whole column: percentile_approx
brackets the middle rank, two counts verify the bracket, and only the values
inside it are counted and summed. ``column_modes`` counts
(column, value) pairs with map-side partial aggregation, so a value holding a
third of the rows is one partial count per task, not a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustframe.functions.exprs import nan_to_null
from trustframe.operators.ranking import prefix_counts


def _long(df: DataFrame, cols: Sequence[str], dtype: str) -> DataFrame:
    tags = F.array(*[F.struct(F.lit(c).alias("feature"),
                              (nan_to_null(F.col(c).cast("double")) if dtype == "double"
                               else F.col(c).cast(dtype)).alias("v")) for c in cols])
    return df.select(F.inline(tags)).where(F.col("v").isNotNull())


def exact_medians(df: DataFrame, cols: Sequence[str], accuracy: int = 100000,
                  narrow_limit: int = 100_000, rows_per_bucket: int = 100_000) -> DataFrame:
    """Exact median per numeric column (mean of the two middle values for an
    even count, like pandas). Output: feature, median (NULL for an all-missing
    column).

    An HLL sketch first splits the columns: where it proves at most
    ``narrow_limit`` distinct values, Spark's exact ``median`` runs (its
    buffer is a value->count map, so memory is bounded by the distinct count);
    wide columns use the verified approximate-quantile bracket."""
    spark = df.sparkSession
    cols = list(cols)
    if not cols:
        return spark.createDataFrame([], "feature string, median double")
    nd = df.agg(*[F.approx_count_distinct(nan_to_null(F.col(c).cast("double")), 0.05).alias(c)
                  for c in cols]).first().asDict()
    narrow = [c for c in cols if nd[c] <= narrow_limit * 0.8]
    wide = [c for c in cols if c not in narrow]
    parts = []
    if narrow:
        med = df.agg(*[F.median(nan_to_null(F.col(c).cast("double"))).alias(c) for c in narrow])
        parts.append(med.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(c).alias("median")) for c in narrow]))))
    if wide:
        parts.append(_bracket_medians(df, wide, accuracy, rows_per_bucket))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _bracket_medians(df: DataFrame, cols: Sequence[str], accuracy: int,
                     rows_per_bucket: int) -> DataFrame:
    """Median through a verified bracket: widened until it holds the middle rank
    of every column, at last to the whole range. Bracket rows are counted per
    value first (a tie of any size is one row) and summed in bounded parts (H1)."""
    spark = df.sparkSession
    long = _long(df, cols, "double")
    eps = 2.0 / accuracy
    for attempt in range(5):
        if attempt == 4:
            eps = 1.0
        lo_q, hi_q = max(0.0, 0.5 - eps), min(1.0, 0.5 + eps)
        # tiny: one row per column
        br = long.groupBy("feature").agg(
            F.count(F.lit(1)).alias("n"),
            F.percentile_approx("v", F.array(F.lit(lo_q), F.lit(hi_q)), accuracy).alias("b"),
            F.min("v").alias("vmin"), F.max("v").alias("vmax"))
        br = br.select("feature", "n",
                       (F.col("vmin") if lo_q <= 0.0 else F.col("b")[0]).alias("lo"),
                       (F.col("vmax") if hi_q >= 1.0 else F.col("b")[1]).alias("hi"))
        br = br.withColumn("k_lo", F.floor((F.col("n") - 1) / 2)) \
               .withColumn("k_hi", F.ceil((F.col("n") - 1) / 2)).cache()
        j = long.join(F.broadcast(br), "feature")  # one row per column
        cnt = j.groupBy("feature").agg(
            F.count_if(F.col("v") < F.col("lo")).alias("n_lt"),
            F.count_if((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))).alias("n_in"))
        chk = br.join(cnt, "feature").withColumn(
            "ok", (F.col("n_lt") <= F.col("k_lo")) & (F.col("k_hi") < F.col("n_lt") + F.col("n_in")))
        bad = chk.where(~F.col("ok")).count()
        if bad == 0:
            break
        if attempt == 4:
            raise RuntimeError("the whole range does not hold the middle rank")
        br.unpersist()
        eps *= 8
    # O(columns) numbers: the verified bracket per column travels as literals,
    # so the final pass scans the table once and ranks only bracket rows
    rows = chk.select("feature", "lo", "hi", "n_lt", "k_lo", "k_hi").collect()
    br.unpersist()
    lit_map = lambda field: F.create_map(*[x for r in rows for x in
                                           (F.lit(r["feature"]), F.lit(r[field]))])[F.col("feature")]
    if not rows:
        allc = spark.createDataFrame([(c,) for c in cols], "feature string")
        return allc.select("feature", F.lit(None).cast("double").alias("median"))
    inside = long.select("feature", "v", *[lit_map(f).alias(f) for f in
                                           ("lo", "hi", "n_lt", "k_lo", "k_hi")]) \
        .where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
    counts = inside.groupBy("feature", "v").agg(F.count(F.lit(1)).alias("c"), *[
        F.first(f).alias(f) for f in ("n_lt", "k_lo", "k_hi")])
    cum = prefix_counts(counts, "feature", "v", ["c"], rows_per_bucket)
    end = F.col("n_lt") + F.col("cum_c")  # rows up to and with this value
    at = lambda k: F.max(F.when((end - F.col("c") <= F.col(k)) & (F.col(k) < end), F.col("v")))
    med = cum.groupBy("feature").agg(((at("k_lo") + at("k_hi")) / 2).alias("median"))
    allc = spark.createDataFrame([(c,) for c in cols], "feature string")
    return allc.join(med, "feature", "left")


def column_modes(df: DataFrame, cols: Sequence[str], empty: str | None = None) -> DataFrame:
    """Most frequent value per column, ties -> smallest; all-missing -> ``empty``.
    Output: column, mode (string)."""
    spark = df.sparkSession
    cols = list(cols)
    if not cols:
        return spark.createDataFrame([], "feature string, mode string")
    counts = _long(df, cols, "string").groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("feature").agg(
        F.min_by(F.col("v"), F.struct(-F.col("n"), F.col("v"))).alias("mode"))
    allc = spark.createDataFrame([(c,) for c in cols], "feature string")
    return allc.join(best, "feature", "left").select(
        "feature", F.coalesce(F.col("mode"), F.lit(empty)).alias("mode"))


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact distinct non-missing values of every column: (feature, n_distinct).
    Values are de-duplicated per (feature, value) with map-side aggregation,
    so no set of values is held in one task."""
    cols = list(cols)
    tags = F.array(*[F.struct(F.lit(c).alias("feature"), (nan_to_null(F.col(c)) if _is_num(df, c)
                                                          else F.col(c)).cast("string").alias("v")) for c in cols])
    d = df.select(F.inline(tags)).where(F.col("v").isNotNull()).groupBy("feature", "v").agg(F.lit(1).alias("one"))
    n = d.groupBy("feature").agg(F.count(F.lit(1)).alias("n_distinct"))
    allc = df.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
    return allc.join(n, "feature", "left").select("feature", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"))


def distinct_small(df: DataFrame, cols: Sequence[str], cap: int = 10,
                   probe: int = 64) -> dict[str, int | None]:
    """Exact distinct count for every column whose count is <= ``cap``; None
    for wider columns. HLL screens first, then a bounded ``collect_set`` runs
    only on columns the sketch puts under ``probe`` (>> cap), so no set grows
    with the data."""
    cols = list(cols)
    if not cols:
        return {}
    approx = df.agg(*[F.approx_count_distinct(nan_to_null(F.col(c)) if _is_num(df, c)
                                              else F.col(c), 0.01).alias(c)
                      for c in cols]).first().asDict()
    narrow = [c for c in cols if approx[c] <= probe]
    exact = {}
    if narrow:
        row = df.agg(*[F.size(F.collect_set(nan_to_null(F.col(c)) if _is_num(df, c)
                                            else F.col(c))).alias(c) for c in narrow]).first()
        exact = row.asDict()
    return {c: (exact[c] if c in exact and exact[c] <= cap else None) for c in cols}


def _is_num(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() in ("double", "float")
