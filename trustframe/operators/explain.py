"""Feature attribution.

Linear models are explained exactly: in margin space phi_j = b_j (x_j - E x_j),
computed as column arithmetic over the whole table (no background sample);
the expectations are one aggregate. Model-agnostic attribution (sampled
Shapley, the LIME surrogates) keeps its seeded perturbations inside the
explained row (arrays), without a shuffle."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from trustframe.session import cut_lineage, importable_in_tasks

#: rows of a Shapley background, which travels inside the plan
MAX_BACKGROUND = 10_000


def feature_means(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """E x_j over the table (one aggregate; O(features) values come back)."""
    r = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return {c: r[c] for c in cols}


def linear_shap(df: DataFrame, coef: Mapping[str, float], keep: Sequence[str],
                means: Mapping[str, float] | None = None) -> DataFrame:
    """One row per (row, feature): keep..., feature, value, shap."""
    means = feature_means(df, list(coef)) if means is None else means
    tags = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                              (F.lit(float(b)) * (F.col(c).cast("double") - F.lit(means[c])))
                              .alias("shap")) for c, b in coef.items()])
    return df.select(*keep, F.inline(tags))


def base_value(coef: Mapping[str, float], intercept: float, means: Mapping[str, float]) -> float:
    """E f(x) in margin space for a linear model."""
    return float(intercept) + sum(float(b) * means[c] for c, b in coef.items())


def global_importance(local: DataFrame) -> DataFrame:
    """E1 + A20 + W5: mean |phi| per feature and its rank (1 = largest)."""
    g = local.groupBy("feature").agg(F.avg(F.abs("shap")).alias("importance"),
                                     F.avg("shap").alias("mean_shap"))
    w = Window.orderBy(F.col("importance").desc(), "feature")  # one row per feature
    return g.withColumn("rank", F.row_number().over(w))


def top_features(global_imp: DataFrame, k: int = 10) -> DataFrame:
    """Top-k features (k is the feature of this report)."""
    return global_imp.where(F.col("rank") <= k)


def by_group(local: DataFrame, group: str) -> DataFrame:
    """Per (group value, feature): rows, mean phi and mean |phi| over the
    whole group (no sampling needed)."""
    return local.groupBy(F.col(group).cast("string").alias("grp"), "feature").agg(
        F.count(F.lit(1)).alias("n"), F.avg("shap").alias("mean_shap"),
        F.avg(F.abs("shap")).alias("mean_abs_shap"))


def overview(local: DataFrame, group: str, k: int = 10) -> DataFrame:
    """The whole analysis in one pass: the top-k features over all rows (grp null) and in each group, with
    rank and importance, and each feature's importance over all rows beside it. The local
    attributions are aggregated once, to one row per (group, feature); the rest works on that table."""
    cells = cut_lineage(local.groupBy(F.col(group).cast("string").alias("grp"), "feature").agg(
        F.count("shap").alias("n"), F.sum("shap").alias("s"), F.sum(F.abs("shap")).alias("a")))
    total = cells.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("a").alias("a"))
    rows = (cells.select(F.lit("group").alias("scope"), "grp", "feature", "n", "s", "a")
            .unionByName(total.select(F.lit("all").alias("scope"), F.lit(None).cast("string").alias("grp"), "feature", "n", "s", "a")))
    rows = rows.select("scope", "grp", "feature", "n", (F.col("s") / F.col("n")).alias("mean_shap"), (F.col("a") / F.col("n")).alias("importance"))
    w = Window.partitionBy("scope", "grp").orderBy(F.col("importance").desc(), "feature")
    overall = total.select("feature", (F.col("a") / F.col("n")).alias("importance_all"))
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).join(overall, "feature")


def additivity_error(df: DataFrame, coef: Mapping[str, float], intercept: float,
                     means: Mapping[str, float]) -> DataFrame:
    """Property: sum_j phi_j = f(x) - E f(x) per row; returns the max error."""
    f = F.lit(float(intercept))
    s = F.lit(0.0)
    for c, b in coef.items():
        f = f + F.lit(float(b)) * F.col(c).cast("double")
        s = s + F.lit(float(b)) * (F.col(c).cast("double") - F.lit(means[c]))
    ef = base_value(coef, intercept, means)
    return df.agg(F.max(F.abs(s - (f - F.lit(ef)))).alias("max_error"),
                  F.count(F.lit(1)).alias("n_rows"))


def report_lines(global_imp: DataFrame, k: int = 10) -> DataFrame:
    """E8: 'rank. feature: importance' lines for the top k."""
    return top_features(global_imp, k).select(
        "rank", F.format_string("%d. %s: %.4f", F.col("rank"), F.col("feature"),
                                F.col("importance")).alias("line"))


# ---------------------------------------------------------------- model-agnostic
def sampled_shapley(df: DataFrame, background: DataFrame, id_col: str, features: Sequence[str],
                    scorer: Callable[[Mapping[str, Column]], Column], n_perm: int = 16,
                    seed: int = 42) -> DataFrame:
    """Permutation-sampled Shapley values. A row holds n_perm permutations as
    columns; permutation m draws one background row (seeded) and a feature
    order (seeded). For feature j the marginal contribution is
    f(x on {pos <= pos_j}, z elsewhere) - f(x on {pos < pos_j}, z elsewhere).
    Output: id, feature, shap (mean over permutations), one row per row of
    ``df`` and feature. ``background`` must be small (a seeded sample, e.g. 100
    rows); its size is checked. It travels with the tasks and every sum stays in
    its row, so nothing is shuffled."""
    bg = background.select(*[F.col(c).cast("double").alias(c) for c in features]).limit(MAX_BACKGROUND + 1).collect()  # bounded sample
    if not 0 < len(bg) <= MAX_BACKGROUND:
        raise ValueError(f"background must hold between 1 and {MAX_BACKGROUND} rows")
    bg.sort(key=lambda r: [(v is not None, v != v, v) for v in r])  # nulls first, NaN last, as the engine sorts
    importable_in_tasks(df.sparkSession)
    rows = df.select(F.col(id_col).alias("__id"), *[F.col(c).cast("double").alias(f"x_{c}") for c in features])

    def of(name: str, m: int, c: str) -> Column:
        return F.col(f"{name}_{m}_{c}")

    def gain(j: str, m: int) -> Column:
        with_j, without_j = {}, {}
        for c in features:
            x, z = F.col(f"x_{c}"), of("z", m, c)
            without_j[c] = z if c == j else F.when(of("k", m, c) < of("k", m, j), x).otherwise(z)
            with_j[c] = x if c == j else without_j[c]
        return scorer(with_j) - scorer(without_j)
    # a column for each permutation and feature, not an array: the engine compiles columns, but interprets lambdas
    names = [f"{x}_{m}_{c}" for x in "kz" for m in range(n_perm) for c in features]
    perms = rows.withColumn("__s", F.col("__id").cast("string")).mapInArrow(
        _permutations(seed, n_perm, list(features), [list(r) for r in bg], names),
        T.StructType([*rows.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]]))
    sums = [(reduce(lambda s, m, j=j: s + gain(j, m), range(n_perm), F.lit(0.0)) / F.lit(float(n_perm))).alias(f"s_{j}") for j in features]
    out = [F.struct(F.lit(j).alias("feature"), F.col(f"s_{j}").alias("shap")) for j in features]
    return perms.select("__id", *sums).select(F.col("__id").alias(id_col), F.inline(F.array(*out)))


def _permutations(seed: int, n_perm: int, features: list[str], background: list[list], names: list[str]):
    """Adds the keys (k) and background values (z) of each row's permutations; the numbers are ``uniform``'s, with the
    row's part of a digest hashed once."""
    tails = [f"{m}:{c}".encode() for m in range(n_perm) for c in features]
    picks = [f"{m}".encode() for m in range(n_perm)]
    table = [pa.array([r[i] for r in background], pa.float64(), from_pandas=False) for i in range(len(features))]

    def numbers(ids: list, start: bytes, ends: list[bytes]) -> np.ndarray:
        out = []
        for x in ids:
            row = hashlib.md5(start + (x.encode() + b":" if x is not None else b""))
            for end in ends:
                h = row.copy()
                h.update(end)
                out.append(h.digest()[:8])
        return (np.frombuffer(b"".join(out), ">u8") >> np.uint64(12)).astype(float).reshape(len(ids), len(ends)) / float(1 << 52)

    def run(batches):
        for b in batches:
            ids = b.column("__s").to_pylist()
            keys = numbers(ids, f"{seed}:".encode(), tails)
            at = np.floor(numbers(ids, f"{seed}:bg:".encode(), picks) * len(background)).astype(np.int32)
            z = [table[i].take(pa.array(at[:, m])) for m in range(n_perm) for i in range(len(features))]
            kept = [c for c in b.schema.names if c != "__s"]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *[pa.array(np.ascontiguousarray(keys[:, i])) for i in range(len(tails))], *z],
                                             [*kept, *names])
    return run


def _draw(*parts) -> float:
    """``uniform`` of constants, in Python."""
    h = hashlib.md5(":".join(str(p) for p in parts).encode()).hexdigest()
    return int(h[:13], 16) / float(1 << 52)


def lime_tabular(df: DataFrame, id_col: str, features: Sequence[str],
                 scorer: Callable[[Mapping[str, Column]], Column], scales: Mapping[str, float],
                 n_samples: int = 200, kernel_width: float | None = None,
                 seed: int = 42) -> DataFrame:
    """Local surrogate per row. Every row is scored at z_s = x + scale * eps_s
    for seeded Gaussian eps (Box-Muller on md5 uniforms), weighted by
    exp(-|eps|^2 / w^2), and f(z) is fitted on eps by weighted least squares.

    The perturbations are drawn once for all rows: their weights and the normal
    matrix don't depend on the row, so the fit is one fixed linear map from a
    row's scores to its coefficients (a (d + 1) x n_samples table, solved here
    once). What is left per row is n_samples scores and d + 1 dot products: a
    narrow projection, no shuffle and no Python in tasks. Output: id, feature,
    weight (effect of one scale unit), intercept."""
    d = len(features)
    w_k = kernel_width or (0.75 * d ** 0.5)
    eps = np.array([[math.sqrt(-2.0 * math.log(max(_draw(seed, s, c, "a"), 1e-12)))
                     * math.cos(2.0 * math.pi * _draw(seed, s, c, "b")) for c in features]
                    for s in range(n_samples)])
    weight = np.exp(-(eps ** 2).sum(1) / w_k ** 2)
    x = np.hstack([np.ones((n_samples, 1)), eps])
    fit = np.linalg.lstsq(x * np.sqrt(weight)[:, None], np.diag(np.sqrt(weight)), rcond=None)[0]
    rows = df.select(F.col(id_col).alias("__id"), *[F.col(c).cast("double").alias(c) for c in features])
    # a column for each sample, not an array: the engine compiles columns, but interprets lambdas
    scored = rows.select("__id", *[scorer({c: F.col(c) + F.lit(float(scales[c])) * F.lit(float(e[i])) for i, c in enumerate(features)}).alias(f"__f{s}")
                                   for s, e in enumerate(eps)])
    dot = lambda r: reduce(lambda t, s: t + F.lit(float(r[s])) * F.col(f"__f{s}"), range(n_samples), F.lit(0.0))
    fitted = scored.select("__id", *[dot(r).alias(f"__w{i}") for i, r in enumerate(fit)])
    out = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"__w{i + 1}").alias("weight")) for i, c in enumerate(features)])
    return fitted.select("__id", F.col("__w0").alias("intercept"), F.inline(out)).select(
        F.col("__id").alias(id_col), "feature", "weight", "intercept")


def lime_text(docs: DataFrame, id_col: str, text_col: str,
              scorer: Callable[[Column], Column], n_samples: int = 64, seed: int = 42,
              counts: Callable[[Column], Column] | None = None) -> DataFrame:
    """E5: word importance per document. In every sample each distinct word of a
    document is kept with probability one half (all its occurrences together);
    the sample is scored on the kept words, and a word's weight is the mean
    score with the word kept minus the mean score with it dropped. The whole
    text is used (no truncation). Output: id, word, weight, n_kept, n_dropped.

    A word's masks are the bits of one md5 digest of (seed, id, word) for every
    128 samples. The samples are scored inside the document's row (arrays); rows are only
    split by word afterwards, so nothing is shuffled. The scores are summed once a document for
    every subset of four samples, and a word looks up the subsets it is kept in.

    ``counts`` says of a word whether the scorer looks at it at all, for a scorer that leaves the others out itself: they
    are then left out once a document, before the samples, instead of in each. Every word is explained either way."""
    toks = docs.select(F.col(id_col).alias("__id"), F.filter(
        F.split(F.lower(F.col(text_col)), r"[^\p{L}\p{N}']+"), lambda x: x != "").alias("__t"))

    blocks = -(-n_samples // 32)
    bits = lambda h, i: F.conv(F.substring(F.get(h, F.lit(i // 4)), 1 + 8 * (i % 4), 8), 16, 10).cast("long")  # noqa: E731  32 samples a number
    digests = lambda w: F.array(*[F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("__id").cast("string"), w, F.lit(str(j))))
                                  for j in range(-(-blocks // 4))])

    def masked(t):  # each digest made once
        hashed = F.transform(t, lambda w: F.struct(w.alias("w"), digests(w).alias("h")))
        return F.transform(hashed, lambda p: F.struct(p["w"].alias("w"), *[bits(p["h"], i).alias(f"b{i}") for i in range(blocks)]))

    def score(s: int) -> Column:
        words = F.transform(F.filter("__z", lambda p: p[f"b{s // 32}"].bitwiseAND(F.lit(1 << s % 32)) != 0), lambda p: p["w"])
        return F.get(F.transform(F.array(words), scorer), F.lit(0))  # words bound once for the scorer
    seen = F.filter("__t", counts) if counts else F.col("__t")
    toks = toks.where(F.size("__t") > 0).select("__id", F.array_distinct("__t").alias("__d"), masked(seen).alias("__z"))
    toks = toks.select("__id", "__d", F.array(*[score(s) for s in range(n_samples)]).alias("__f"))
    # sums of the scores of samples 4 i to 4 i + 3, for every subset of them: entry 16 i + the subset's bits
    sums = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(n_samples), F.lit(4)), lambda i: F.aggregate(
        F.slice("__f", i, F.lit(4)), F.array(F.lit(0.0)), lambda t, v: F.concat(t, F.transform(t, lambda x: x + v)))))
    toks = toks.select("__id", "__d", F.aggregate("__f", F.lit(0.0), lambda t, v: t + v).alias("__all"), sums.alias("__sums"))
    x = toks.select("__id", "__all", "__sums", F.explode("__d").alias("word")).withColumn("__h", digests(F.col("word")))
    x = x.select("__id", "__all", "__sums", "word", *[
        bits(F.col("__h"), i).bitwiseAND(F.lit((1 << min(32, n_samples - 32 * i)) - 1)).alias(f"__b{i}") for i in range(blocks)])

    def looked_up(s: int) -> Column:
        subset = F.shiftright(f"__b{s // 32}", s % 32).bitwiseAND(F.lit(15)).cast("int")
        return F.get("__sums", F.lit(4 * s) + subset)
    on = reduce(lambda t, s: t + looked_up(s), range(0, n_samples, 4), F.lit(0.0))
    n_kept = reduce(lambda t, i: t + F.bit_count(f"__b{i}"), range(blocks), F.lit(0)).cast("long")
    x = x.select("__id", "__all", "word", on.alias("on"), n_kept.alias("n_kept"))
    off = F.lit(n_samples) - F.col("n_kept")
    return x.select(F.col("__id").alias(id_col), "word",
                    (F.try_divide("on", "n_kept") - F.try_divide(F.col("__all") - F.col("on"), off)).alias("weight"),
                    "n_kept", off.alias("n_dropped"))
