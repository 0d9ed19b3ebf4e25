"""Small DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustframe.session import cut_lineage, ensure_checkpoint_dir


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names based on ``wanted`` that ``df`` does not have (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for w in wanted:
        name = w
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def local_ranks(df: DataFrame, order, part: str, rank: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder with the number of the task
    that wrote each row (``part``) and the row's place in it (``rank``, from 0,
    in ``order``). (part, rank) names a row for good: what a retried task
    commits is one consistent numbering, whatever order it read its rows in."""
    mid = F.monotonically_increasing_id()
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    if order is not None:
        df = df.sortWithinPartitions(order)
    (df.withColumn(part, mid)
       .withColumn(rank, F.col(part).bitwiseAND(F.lit((1 << 33) - 1)))
       .withColumn(part, F.shiftright(part, 33).cast("int"))
       .write.parquet(path))
    return spark.read.parquet(path)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (u, v: long; every row a link).

    Alternating large-star and small-star rounds: each node hands its larger
    neighbours (then its smaller ones) to its smallest neighbour, until the
    edges are stars around each component's smallest node. Every round is two
    aggregations and two joins, written to the checkpoint folder. Returns
    (node, root) for each node that has a link; ``root`` is the smallest node."""
    e = cut_lineage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                                 F.least("u", "v").alias("v")).distinct())
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(m, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(m, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(m.select("u", F.col("m").alias("v"))).distinct())
        e = cut_lineage(small)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
