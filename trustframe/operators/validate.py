"""Data validation: class distribution, imbalance, missing values, report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def class_distribution(df: DataFrame, label: str | Column) -> DataFrame:
    """label, n, share."""
    c = F.col(label) if isinstance(label, str) else label
    counts = df.groupBy(c.alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(_all())
    return counts.select("label", "n", (F.col("n") / total).alias("share"))


def _all():
    from pyspark.sql.window import Window
    return Window.partitionBy()  # over the class-count table only (one row per class)


def class_ratio(dist: DataFrame, warn_below: float = 0.1) -> DataFrame:
    """min/max class count ratio and the imbalance warning flag."""
    return dist.agg(F.min("n").alias("min_class"), F.max("n").alias("max_class")).select(
        "min_class", "max_class",
        (F.col("min_class") / F.col("max_class")).alias("class_ratio"),
        ((F.col("min_class") / F.col("max_class")) < warn_below).alias("imbalance_warning"))


def validation_report(df: DataFrame, label: str, protected: Sequence[str],
                      high_missing: float = 0.5, warn_below: float = 0.1) -> DataFrame:
    """One row: rows, feature columns, missing protected attributes, class
    counts/ratio, mean missing fraction, columns over the missing bound.

    One scan: missing counts are summed per class in the same grouped
    aggregate that counts the classes; the rest works on that per-class
    table (one row per class)."""
    from pyspark.sql import types as T
    spark = df.sparkSession
    feats = [c for c in df.columns if c != label]
    absent = sorted(set(protected) - set(df.columns))
    miss = []
    for f in df.schema.fields:
        if f.name == label:
            continue
        m = F.col(f.name).isNull()
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            m = m | F.isnan(f.name)
        miss.append(F.count_if(m).alias(f"__m_{f.name}"))
    per_class = df.groupBy(F.col(label).alias("__y")).agg(F.count(F.lit(1)).alias("__n"), *miss)
    n = F.sum("__n")
    fracs = [F.sum(f"__m_{c}") / n for c in feats]
    mean_missing = sum(fracs[1:], fracs[0]) / F.lit(len(feats)) if feats else F.lit(0.0)
    high = F.array(*[F.when(fr > high_missing, F.lit(c)) for c, fr in zip(feats, fracs)]) \
        if feats else F.array().cast("array<string>")
    one = per_class.agg(
        n.alias("n_rows"), F.min("__n").alias("min_class"), F.max("__n").alias("max_class"),
        mean_missing.alias("mean_missing"), high.alias("__high"))
    high_list = F.array_sort(F.filter("__high", lambda x: x.isNotNull()))
    return one.select(
        "n_rows", F.lit(len(feats)).alias("n_features"),
        F.lit(",".join(absent)).alias("missing_protected"), "min_class", "max_class",
        (F.col("min_class") / F.col("max_class")).alias("class_ratio"),
        ((F.col("min_class") / F.col("max_class")) < warn_below).alias("imbalance_warning"),
        "mean_missing", F.size(high_list).cast("long").alias("n_high_missing"),
        F.concat_ws(",", high_list).alias("high_missing"),
        (F.col("n_rows") == 0).alias("empty"))
