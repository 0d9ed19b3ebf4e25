"""The corpus pipeline: five operators of ``trustframe.llm`` in a row.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and returns
a DataFrame; stages are written as Parquet and read again. All but the last return the columns
of ``documents``.

1. toxicity: a classifier learned from the table's labels; documents at or above their
   language's cut go.
2. simhash: one document of each group of near copies stays (4-word shingles, 4 bits).
3. decontaminate: documents that hold a benchmark item go.
4. mix: documents fill the budgets of the domain-language-source tree, whole epochs first.
5. shard: a uniform shuffle into 40 shards; adds shard and slot.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from trustframe.llm import decontaminate, queries, shuffle_shards, simhash, toxicity
from trustframe.session import ensure_checkpoint_dir
from trustframe.sources.tables import table

SHARDS = 40
#: the mixture's budget: all tokens there are, in at most two epochs
SHARE, EPOCHS = (1, 1), 2


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.prepare(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    flag = scored.columns[-1]  # rejected, under a free name
    return scored.where(~scored[flag]).select(*[scored[f"`{c}`"] for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.prepare(spark)
    return simhash.keep_one(docs, k=4, d=4)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.prepare(spark)
    return decontaminate.drop_leaks(docs, decontaminate.build_index(table(spark, sf_dir, "benchmark")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.prepare(spark)
    m = queries.mix(docs, SHARE, EPOCHS)
    return m.select(*[m[f"`{c}`"] for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.prepare(spark)
    return shuffle_shards.shuffle_into_shards(docs, SHARDS)


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_copies), ("decontaminate", drop_benchmark_leaks),
          ("mix", mix_sources), ("shard", shard)]
#: SQL cannot state the classifier, the fingerprints or the draws
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on ``documents``, each written to the checkpoint folder and read again."""
    queries.prepare(spark)
    base = ensure_checkpoint_dir(spark).rstrip("/")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{base}/pipeline/{uuid.uuid4().hex}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
