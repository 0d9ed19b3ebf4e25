"""Rank-based helpers that never funnel a stratum or a column into one task.

H2 ``rank_segments``: exact seeded ranks within strata. Rows are ordered by
``md5('<seed>:<id>')``; the first ``digits`` hex characters of that key split
every stratum into 16**digits buckets. Bucket counts (a small table) give each
bucket its first rank; a bucket that lies wholly inside one segment (e.g.
"test", "keep") is labelled by a join, and only the few buckets that straddle
a cut are ranked row by row, each in its own window partition. The result
equals ``row_number() over (partition by strata order by key, id)``.

H1 ``prefix_counts``: cumulative counts over the sorted distinct values of
a column, per feature, without a window over a whole feature: rows are
range-partitioned, part totals give offsets, and each part is summed in its own
window partition.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trustframe.functions.exprs import order_key
from trustframe.functions.joins import materialize_small
from trustframe.session import cut_lineage

#: parts of a sorted column while none of them passes PART_ROWS: a part is a task and a file, whatever it holds
MAX_PARTS, PART_ROWS = 256, 1_000_000


def ceil_share(n: Column, share: float) -> Column:
    """ceil(n * share) in integer arithmetic (share to 1e-6)."""
    num = int(round(share * 1_000_000))
    d = n.cast("decimal(38,0)")  # exact integer arithmetic, no double rounding
    return F.floor((d * F.lit(num) + F.lit(999_999)) / F.lit(1_000_000)).cast("long")


def _segment(pos: Column, cuts: Sequence[Column], labels: Sequence[str]) -> Column:
    expr = None
    for c, lab in zip(cuts, labels[:-1]):
        cond = pos <= c
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    last = F.lit(labels[-1])
    return last if expr is None else expr.otherwise(last)


def rank_segments(df: DataFrame, strata: Sequence[str | Column], id_col: str, seed: int | str,
                  cuts: Callable[[Column], Sequence[Column]], labels: Sequence[str],
                  out: str = "segment", digits: int | None = None,
                  max_broadcast_rows: int = 2_000_000,
                  rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Label every row with the segment its seeded rank falls in.

    ``cuts(n)`` returns increasing cumulative cut positions (Columns over the
    stratum size ``n``); ranks 1..cut1 get labels[0], ..cut2 labels[1], and
    everything after the last cut gets labels[-1]. ``id_col`` must be unique
    within a stratum. Also adds ``__n`` (stratum size).

    ``digits=None`` sizes the buckets from the largest stratum (one grouped
    count first): enough hex digits that a bucket holds about
    ``rows_per_bucket`` rows, so even a stratum with a third of all rows is
    ranked in bounded pieces."""
    if len(labels) != len(cuts(F.lit(0))) + 1:
        raise ValueError("need one more label than cuts")
    names = [s if isinstance(s, str) else f"__s{i}" for i, s in enumerate(strata)]
    extra = [s.alias(nm) for s, nm in zip(strata, names) if not isinstance(s, str)]
    base = df.select("*", *extra, order_key(id_col, seed).alias("__k"))
    if digits is None:
        sizes = base.groupBy(*names).agg(F.count(F.lit(1)).alias("c"))
        big = sizes.agg(F.max("c")).first()[0] or 1
        digits = 2
        while digits < 8 and big / (16 ** digits) > rows_per_bucket:
            digits += 1
    base = base.withColumn("__b", F.substring("__k", 1, digits))
    keys = names + ["__b"]
    counts = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("__cnt"))
    w = Window.partitionBy(*names) if names else Window.partitionBy(F.lit(0))
    # bounded: <= 16**digits rows per stratum
    counts = counts.select(
        *keys, "__cnt",
        (F.sum("__cnt").over(w.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("__start"),
        F.sum("__cnt").over(w).alias("__n"))
    counts = counts.withColumn("__start", F.coalesce("__start", F.lit(0)))
    cs = cuts(F.col("__n"))
    counts = counts.select(
        "*",
        _segment(F.col("__start") + 1, cs, labels).alias("__first"),
        _segment(F.col("__start") + F.col("__cnt"), cs, labels).alias("__last"))
    # materialised once: both branches below read it (each pushes its own
    # filter into the build side, so an un-materialised table would be
    # computed twice)
    counts, small = materialize_small(counts, max_broadcast_rows)
    side = F.broadcast(counts) if small else counts
    j = base.join(side, keys, "inner")
    pure = j.where(F.col("__first") == F.col("__last")).withColumn(out, F.col("__first"))
    mixed = j.where(F.col("__first") != F.col("__last"))
    rw = Window.partitionBy(*keys).orderBy("__k", id_col)
    mixed = mixed.withColumn("__pos", F.col("__start") + F.row_number().over(rw)) \
        .withColumn(out, _segment(F.col("__pos"), cuts(F.col("__n")), labels)).drop("__pos")
    res = pure.unionByName(mixed)
    tmp = [nm for nm in names if nm.startswith("__s")]
    return res.drop(*tmp, "__k", "__b", "__cnt", "__start", "__first", "__last")


def top_n_per_stratum(df: DataFrame, strata: Sequence[str | Column], id_col: str, seed,
                      n: Callable[[Column], Column], digits: int | None = None) -> DataFrame:
    """Exact seeded top-n rows per stratum (``n`` may depend on the stratum
    size ``__n``)."""
    r = rank_segments(df, strata, id_col, seed, lambda N: [n(N)], ["keep", "drop"],
                      "__seg", digits)
    return r.where(F.col("__seg") == "keep").drop("__seg", "__n")


def prefix_counts(long: DataFrame, key: str, value: str, count_cols: Sequence[str],
                  rows_per_bucket: int = 100_000, materialized: bool = False) -> DataFrame:
    """Cumulative sums of ``count_cols`` over increasing ``value`` within each
    ``key`` plus ``next_value`` (the following distinct value, NULL at the end).

    ``long`` must hold one row per (key, value) (already aggregated, so a tie
    is one row however many input rows share it). Output adds ``cum_<c>`` for
    each count column and ``next_value``.

    The rows are range-partitioned by (key, value) into as many parts as hold
    about ``rows_per_bucket`` rows each, or more where these would be over ``MAX_PARTS`` (up to
    ``PART_ROWS`` each). Spark samples the rows themselves for
    the bounds, so parts stay even under heavy tails, any number of keys and
    any size; nothing is collected but the row count. Part totals per key give
    offsets, and each row is summed only inside its own part. The histogram is
    read by several jobs, so it is written once unless the caller already did
    (``materialized=True``); the raw table behind it is scanned once."""
    if not materialized:
        long = cut_lineage(long)
    rows = long.count()
    parts = max(1, min(-(-rows // rows_per_bucket), max(MAX_PARTS, -(-rows // PART_ROWS))))
    if parts == 1:  # all keys together fit one part: their windows are small
        w = Window.partitionBy(key).orderBy(value)
        run = w.rowsBetween(Window.unboundedPreceding, 0)
        return long.select(*long.columns, *[F.sum(c).over(run).alias(f"cum_{c}") for c in count_cols],
                           F.lead(value).over(w).alias("next_value"))
    ranged = range_parts(long, [key, value], parts)
    tot = ranged.groupBy(key, "__part").agg(*[F.sum(c).alias(f"__t_{c}") for c in count_cols],
                                            F.min(value).alias("__min"))
    wk = Window.partitionBy(key).orderBy("__part")  # at most one row per part
    prev = wk.rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(F.col(key).alias("__key"), F.col("__part").alias("__p"),
                     *[F.coalesce(F.sum(f"__t_{c}").over(prev), F.lit(0)).alias(f"__o_{c}")
                       for c in count_cols],
                     F.lead("__min").over(wk).alias("__next_min"))
    tot, small = materialize_small(tot)
    j = ranged.join(F.broadcast(tot) if small else tot,
                    F.col(key).eqNullSafe(F.col("__key")) & (F.col("__part") == F.col("__p")))
    wb = Window.partitionBy(key, "__part").orderBy(value)
    run = wb.rowsBetween(Window.unboundedPreceding, 0)
    return j.select(
        *[c for c in long.columns],
        *[(F.col(f"__o_{c}") + F.sum(c).over(run)).alias(f"cum_{c}") for c in count_cols],
        F.coalesce(F.lead(value).over(wb), F.col("__next_min")).alias("next_value"))


def range_parts(df: DataFrame, cols: Sequence[str], parts: int) -> DataFrame:
    """df written once, range-partitioned by ``cols`` into ``parts`` ordered parts;
    adds ``__part`` (int)."""
    return cut_lineage(df.repartitionByRange(parts, *cols)
                       .withColumn("__part", F.spark_partition_id()))
