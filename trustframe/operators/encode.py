"""Encoding (A9, X2-X5): population-std scaling and drop-first one-hot, fit
on one DataFrame (e.g. the train split) and applied to any other.

Fitting is one aggregate for the numeric moments and one distinct scan for
the categories. Columns with up to ``MAX_LISTED`` categories are applied as
literal column arithmetic, so ``transform`` is a narrow projection inside
whole-stage codegen. Columns with more keep their categories as a table
(feature, v, pos) of any size, which ``transform(output="sparse")`` joins."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustframe.functions.joins import MAX_BROADCAST_ROWS
from trustframe.operators.ranking import prefix_counts
from trustframe.session import cut_lineage

MAX_LISTED = 1000


def scaler_params(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean and population std per column (sample std is NOT what the
    reference's scaler uses). Output: feature, mean, std."""
    agg = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                 *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])
    stack = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"),
                               F.col(f"s_{c}").alias("std")) for c in cols])
    return agg.select(F.inline(stack))


@dataclass
class EncoderModel:
    numeric: list[str]
    means: dict[str, float]
    stds: dict[str, float]
    categorical: list[str]
    categories: dict[str, list[str]] = field(default_factory=dict)
    #: columns with more than MAX_LISTED categories: (table of v and pos from 0, categories)
    wide: dict[str, tuple[DataFrame, int]] = field(default_factory=dict)

    def feature_names(self) -> list[str]:
        """Numerics in order, then <col>_<value> for kept categories."""
        self._listed()
        names = list(self.numeric)
        for c in self.categorical:
            names += [f"{c}_{v}" for v in self.categories[c][1:]]
        return names

    def _listed(self) -> None:
        if self.wide:
            raise ValueError(f"{sorted(self.wide)}: more than {MAX_LISTED} categories; use output='sparse'")

    def width(self) -> int:
        """Number of features."""
        kept = [self.wide[c][1] if c in self.wide else len(self.categories[c]) for c in self.categorical]
        return len(self.numeric) + sum(max(0, k - 1) for k in kept)

    def _sparse(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """size, indices and values of the features that are not 0, indices ascending."""
        entries = []
        for i, c in enumerate(self.numeric):
            s = self.stds[c]
            v = (F.col(c) - F.lit(self.means[c])) / F.lit(1.0 if s is None or s == 0.0 else s)
            entries.append(F.struct(F.lit(i).cast("long").alias("i"), v.cast("double").alias("v")))
        at = len(self.numeric)
        for n, c in enumerate(self.categorical):
            if c in self.wide:
                t, k = self.wide[c]
                t = t.select(F.col("v").alias(f"__v{n}"), F.col("pos").alias(f"__p{n}"))
                t = F.broadcast(t) if k <= MAX_BROADCAST_ROWS // 20 else t
                df = df.join(t, F.col(c).cast("string") == F.col(f"__v{n}"), "left").drop(f"__v{n}")
                pos = F.col(f"__p{n}")
            else:
                vals = self.categories[c]
                k = len(vals)
                found = F.array_position(F.array(*[F.lit(v) for v in vals]), F.col(c).cast("string")) if vals else F.lit(0)
                pos = F.nullif(found, F.lit(0)) - 1
            entries.append(F.when(pos >= 1, F.struct((pos + (at - 1)).cast("long").alias("i"), F.lit(1.0).alias("v"))))
            at += max(0, k - 1)
        e = F.filter(F.array(*entries), lambda x: x.isNotNull() & (x["v"].isNull() | (x["v"] != 0)))
        return df.select(*keep, F.lit(at).cast("long").alias("size"), F.transform(e, lambda x: x["i"]).alias("indices"),
                         F.transform(e, lambda x: x["v"]).alias("values"))

    def columns(self):
        self._listed()
        out = []
        for c in self.numeric:
            s = self.stds[c]
            s = 1.0 if (s is None or s == 0.0) else s
            out.append(((F.col(c) - F.lit(self.means[c])) / F.lit(s)).alias(c))
        for c in self.categorical:
            for v in self.categories[c][1:]:  # first category dropped
                out.append(F.when(F.col(c).cast("string") == F.lit(v), F.lit(1.0))
                           .otherwise(F.lit(0.0)).alias(f"{c}_{v}"))
        return out

    def transform(self, df: DataFrame, keep: Sequence[str] = (), output: str = "columns"
                  ) -> DataFrame:
        """``columns``: one column per feature; ``array``: array<double>
        ``features``; ``vector``: ML vector ``features``; ``sparse``: size,
        indices and values, for any number of categories. Unseen categories
        encode as all zeros."""
        if output == "sparse":
            return self._sparse(df, keep)
        cols = self.columns()
        if output == "columns":
            return df.select(*keep, *cols)
        arr = F.array(*[c for c in cols])
        if output == "array":
            return df.select(*keep, arr.alias("features"))
        return df.select(*keep, array_to_vector(arr).alias("features"))

    # Parameters as a small Parquet table + JSON metadata
    def save(self, spark: SparkSession, path: str) -> None:
        rows = [("numeric", c, i, self.means[c], self.stds[c], None)
                for i, c in enumerate(self.numeric)]
        for c in self.categorical:
            rows += [("categorical", c, i, None, None, v) for i, v in enumerate(self.categories.get(c, []))]
        spark.createDataFrame(rows, "kind string, feature string, pos int, mean double, "
                                    "std double, category string") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/params")
        for c, (t, _) in self.wide.items():
            t.select(F.lit(c).alias("feature"), "v", "pos").write.mode("append").partitionBy("feature").parquet(f"{path}/wide")
        meta = {"numeric": self.numeric, "categorical": self.categorical, "wide": {c: k for c, (_, k) in self.wide.items()}}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
            .write.mode("overwrite").text(f"{path}/metadata")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "EncoderModel":
        meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        rows = spark.read.parquet(f"{path}/params").orderBy("kind", "feature", "pos").collect()
        means = {r.feature: r.mean for r in rows if r.kind == "numeric"}
        stds = {r.feature: r.std for r in rows if r.kind == "numeric"}
        cats: dict[str, list[str]] = {c: [] for c in meta["categorical"]}
        for r in rows:
            if r.kind == "categorical":
                cats[r.feature].append(r.category)
        wide = {c: (spark.read.parquet(f"{path}/wide").where(F.col("feature") == c).select("v", "pos"), k)
                for c, k in meta.get("wide", {}).items()}
        return cls(meta["numeric"], means, stds, meta["categorical"], cats, wide)


def fit_encoder(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                max_listed: int = MAX_LISTED) -> EncoderModel:
    """Fit scaler moments and sorted categories (ascending), however many."""
    means, stds = {}, {}
    if numeric:
        for r in scaler_params(df, numeric).collect():  # one row per column
            means[r.feature], stds[r.feature] = r["mean"], r["std"]
    cats: dict[str, list[str]] = {c: [] for c in categorical}
    wide: dict[str, tuple[DataFrame, int]] = {}
    if categorical:
        tags = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v"))
                         for c in categorical])
        d = cut_lineage(df.select(F.inline(tags)).where(F.col("v").isNotNull()).distinct())
        sizes = {r["feature"]: r["n"] for r in d.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}  # one per column
        narrow = [c for c in categorical if sizes.get(c, 0) <= max_listed]
        for r in d.where(F.col("feature").isin(narrow)).collect():  # at most max_listed a column
            cats[r["feature"]].append(r["v"])
        cats = {c: sorted(v) for c, v in cats.items()}
        for c in categorical:
            if c not in narrow:
                # places in sorted order by the distributed running count
                t = prefix_counts(d.where(F.col("feature") == c).withColumn("one", F.lit(1)), "feature", "v", ["one"])
                wide[c] = (cut_lineage(t.select("v", (F.col("cum_one") - 1).alias("pos"))), sizes[c])
    return EncoderModel(list(numeric), means, stds, list(categorical), cats, wide)
