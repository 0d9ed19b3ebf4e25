"""Synthetic minority rows (M7) and the whole preparation with a balanced train split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustframe.functions.exprs import uniform
from trustframe.operators.encode import EncoderModel, fit_encoder
from trustframe.operators.neighbors import knn_self_join
from trustframe.operators.sampling import resample_to, stratified_split
from trustframe.session import cut_lineage

MAX_CLASSES = 1000


def smote(df: DataFrame, id_col: str, label: str, vec: Column, k: int = 5, seed: int = 42) -> DataFrame:
    """M7: every class grown to the largest class's size by rows between neighbours of one class.

    Columns: ``id_col``, ``label``, ``features``, synthetic_of, neighbor, copy. The rows of df come unchanged, with
    nulls in the last three. A synthetic row has a null id, so no join on the id can take it for a real one;
    (synthetic_of, copy) names it. Its features are x + g (y - x) for its base row x, one of x's k nearest
    rows of the class y, and g in [0, 1), both drawn by hash from (seed, base id, copy). The base rows are dealt
    evenly: where fewer rows are missing than there are, a seeded subset, else equally many
    copies of each and one more for a seeded subset.

    A class that can't give k neighbours (k rows or fewer with whole vectors) leaves the data unchanged, as does an
    empty table. Rows with a null label are kept and no class; rows whose vector or id is null, or whose vector holds a
    null or NaN, are kept and no base."""
    kind = df.schema[id_col].dataType
    src = df.select(F.col(id_col), F.col(label), F.transform(vec, lambda x: x.cast("double")).alias("features"))
    out = src.select("*", F.lit(None).cast(kind).alias("synthetic_of"), F.lit(None).cast(kind).alias("neighbor"), F.lit(None).cast("int").alias("copy"))
    whole = F.col(id_col).isNotNull() & F.col("features").isNotNull() & ~F.exists("features", lambda x: x.isNull() | F.isnan(x))
    sizes = (src.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"), F.count_if(whole).alias("usable"))
             .limit(MAX_CLASSES + 1).collect())
    if len(sizes) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    top = max((r["n"] for r in sizes), default=0)
    grow = [r for r in sizes if r["n"] < top]
    if any(r["usable"] <= k for r in grow):
        return out
    for r in grow:
        rows = cut_lineage(src.where(whole & (F.col(label) == F.lit(r[label]))))
        near = knn_self_join(rows, id_col, F.col("features"), k, seed).select(F.col(id_col).alias("__base"), "rank", "neighbor")
        new = resample_to(rows, [label], id_col, lambda n, r=r: F.lit(top - r["n"]).cast("long"), seed)
        draw = lambda what: uniform(F.lit(seed), F.lit(what), F.col(id_col), F.col("copy"))
        new = new.select("*", (F.floor(draw("neighbor") * k) + 1).cast("int").alias("rank"), draw("gap").alias("__g"))
        other = rows.select(F.col(id_col).alias("neighbor"), F.col("features").alias("__y"))
        new = new.join(near, (F.col(id_col) == F.col("__base")) & (new["rank"] == near["rank"])).join(other, "neighbor")
        gap = F.zip_with("features", "__y", lambda x, y: x + F.col("__g") * (y - x))
        out = out.unionByName(new.select(F.lit(None).cast(kind).alias(id_col), label, gap.alias("features"),
                                         F.col("__base").alias("synthetic_of"), "neighbor", "copy"))
    return out


def prepare(df: DataFrame, id_col: str, label: str, numeric: Sequence[str], categorical: Sequence[str], strata: Sequence | None = None,
            test: float = 0.2, val: float = 0.1, balance: bool = True, k: int = 5, seed: int = 42) -> tuple[DataFrame, EncoderModel]:
    """Stratified split, encoder fitted on the train split, all splits encoded, the train split balanced.

    Returns the rows (``id_col``, split, ``label``, ``features``, synthetic_of, neighbor, copy; see ``smote``) and the
    encoder. Validation and test rows are encoded only: no row is added there, and none of theirs reaches the fit or a
    neighbourhood. ``strata`` defaults to the label."""
    cols = [id_col, label, *[c for c in (*numeric, *categorical) if c not in (id_col, label)]]
    s = cut_lineage(stratified_split(df.select(*cols), strata or [label], id_col, seed, test, val))
    enc = fit_encoder(s.where(F.col("split") == "train"), numeric, categorical)
    e = cut_lineage(enc.transform(s, keep=[id_col, "split", label], output="array"))
    train = e.where(F.col("split") == "train")
    kind = df.schema[id_col].dataType
    rest = e.where(F.col("split") != "train").select("*", F.lit(None).cast(kind).alias("synthetic_of"), F.lit(None).cast(kind).alias("neighbor"),
                                                     F.lit(None).cast("int").alias("copy"))
    if not balance:
        return train.select("*", *[F.lit(None).cast(rest.schema[c].dataType).alias(c) for c in ("synthetic_of", "neighbor", "copy")]).unionByName(rest), enc
    return smote(train, id_col, label, F.col("features"), k, seed).withColumn("split", F.lit("train")).unionByName(rest), enc
