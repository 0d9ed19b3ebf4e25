"""Exact seeded sampling and splits (M4, M8, M9, M11-M14) on top of H2.

Nothing here uses ``rand()`` or ``sampleBy``: every choice is a function of
``md5('<seed>:<id>')``, so reruns (and retried tasks) reproduce the same rows
and the counts per stratum are exact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustframe.functions.exprs import order_key
from trustframe.operators.ranking import ceil_share, rank_segments, top_n_per_stratum


COPIES_PER_BLOCK = 1000


def stratified_split(df: DataFrame, strata: Sequence, id_col: str, seed: int = 42,
                     test: float = 0.2, val: float = 0.1, out: str = "split") -> DataFrame:
    """Train/val/test per stratum: n_test = ceil(n*test); n_val =
    ceil((n - n_test) * val/(1-test)); rest train. With ``val=0`` a two-way
    split (M13)."""
    vs = val / (1.0 - test) if val else 0.0

    def cuts(n):
        nt = ceil_share(n, test)
        if not val:
            return [nt]
        return [nt, nt + ceil_share(n - nt, vs)]
    labels = ["test", "val", "train"] if val else ["test", "train"]
    return rank_segments(df, strata, id_col, seed, cuts, labels, out).drop("__n")


def composite_strata(df: DataFrame, label: str, attrs: Sequence[str], test: float = 0.2,
                     val: float = 0.1) -> tuple[Column, str]:
    """Stratify on the label and the attributes together; if the smallest such
    stratum has fewer than max(2, int(1/min(test, val))) rows fall back to the
    label. Returns the stratum expression and which rule was used (one scalar is
    fetched from a grouped count). The key is the JSON of the values, so a
    missing value or a separator inside a value never joins two strata."""
    key = F.to_json(F.array(*[F.col(c).cast("string") for c in [label, *attrs]]))
    need = max(2, int(1.0 / min(test, val)))
    smallest = df.groupBy(key.alias("k")).count().agg(F.min("count")).first()[0]
    if smallest is not None and smallest >= need:
        return key, "composite"
    return F.col(label).cast("string"), "label"


def balanced_cells(df: DataFrame, attr: str, label: str, id_col: str, seed: int = 42) -> DataFrame:
    """M4: every (attr, label) cell down to the smallest cell's size; the
    smallest cell is kept whole (no bootstrap duplicates)."""
    cell_min = df.groupBy(attr, label).count().agg(F.min("count")).first()[0] or 0
    return top_n_per_stratum(df, [attr, label], id_col, seed, lambda n: F.lit(cell_min))


def resample_to(df: DataFrame, strata: Sequence, id_col: str, target: Column,
                seed: int = 42) -> DataFrame:
    """Exactly ``target`` rows per stratum (``target`` over ``__n``): without
    replacement when shrinking, deterministic copies when growing. Adds
    ``copy``."""
    def cuts(n):
        t = target if not callable(target) else target(n)
        rem = F.when(t > n, t % n).otherwise(t)
        return [rem]
    t_of = target if callable(target) else (lambda n: target)
    r = rank_segments(df, strata, id_col, seed, cuts, ["first", "rest"], "__seg")
    n = F.col("__n")
    t = t_of(n)
    whole = F.when(t > n, F.floor(t / n)).otherwise(F.lit(0)).cast("int")
    ncopies = whole + F.when(F.col("__seg") == "first", 1).otherwise(0)
    r = r.withColumn("__nc", ncopies).where(F.col("__nc") > 0)
    # growing: blocks of copies first, dealt to all tasks, then the copies of each
    # block, so a few rows that grow to very many are not expanded in a few tasks
    if n_grow(df, strata, t_of) > COPIES_PER_BLOCK:
        blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("__nc") - 1) / COPIES_PER_BLOCK))
        r = r.select("*", F.explode(blocks).alias("__blk"))
        r = r.repartition(id_col, "__blk")
        lo = F.col("__blk") * COPIES_PER_BLOCK
        copies = F.sequence(lo, F.least(lo + COPIES_PER_BLOCK, F.col("__nc").cast("long")) - 1).cast("array<int>")
        return r.select("*", F.explode(copies).alias("copy")).drop("__seg", "__n", "__nc", "__blk")
    return r.select("*", F.explode(F.sequence(F.lit(0), F.col("__nc") - 1)).alias("copy")) \
        .drop("__seg", "__n", "__nc")


def n_grow(df: DataFrame, strata: Sequence, t_of) -> int:
    """Most copies that one row gets (one number, from the strata's counts)."""
    names = [s if isinstance(s, str) else s.alias(f"__s{i}") for i, s in enumerate(strata)]
    sizes = df.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    return sizes.agg(F.max(F.ceil(t_of(F.col("__n")) / F.col("__n")))).first()[0] or 0


def inject_bias(df: DataFrame, attr: str, id_col: str, ratio=(0.6, 0.4), seed: int = 42
                ) -> DataFrame:
    """M8: majority group (largest count, ties smallest value; rows without the
    attribute are a group like any other) resampled to int(n*ratio[0]) rows,
    everything else to int(n*ratio[1]). Adds
    ``bias_group`` ('majority'/'minority') and ``copy``."""
    counts = df.groupBy(F.col(attr).cast("string").alias("g")).count()
    best = counts.agg(F.min_by("g", F.struct(-F.col("count"), F.col("g"))).alias("m"),
                      F.sum("count").alias("n")).first()
    major, n = best["m"], best["n"]
    grp = F.when(F.col(attr).cast("string").eqNullSafe(F.lit(major)), "majority").otherwise("minority")
    tmaj, tmin = int(n * ratio[0]), int(n * ratio[1])
    tagged = df.withColumn("bias_group", grp)
    target = F.when(F.col("bias_group") == "majority", F.lit(tmaj)).otherwise(F.lit(tmin))
    return resample_to(tagged, ["bias_group"], id_col, lambda n_: target, seed)


def oversample(df: DataFrame, label: str, id_col: str, seed: int = 42) -> DataFrame:
    """M9: every class up to the largest class size (copies; the largest class
    is unchanged)."""
    top = df.groupBy(label).count().agg(F.max("count")).first()[0] or 0
    return resample_to(df, [label], id_col, lambda n: F.lit(top).cast("long"), seed)


def sample_per_group(df: DataFrame, group: str | None, id_col: str, n: int, seed: int = 42
                     ) -> DataFrame:
    """N rows overall (group=None) or n rows per group value."""
    strata = [] if group is None else [group]
    return top_n_per_stratum(df, strata, id_col, seed, lambda N: F.lit(n))


def seeded_order(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """A reproducible shuffle order, only when order matters."""
    return df.orderBy(order_key(id_col, seed), id_col)
