"""Work that must not grow faster than the rows: parts of a sorted column, compiled explainers, dealt tasks."""

import pytest
from pyspark.sql import functions as F

from trustframe.operators import explain, ranking
from trustframe.operators import models as ml
from trustframe.sources.tables import deal_small


def plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_small_buckets_do_not_make_a_task_each(spark, monkeypatch):
    asked = []
    parts = ranking.range_parts
    monkeypatch.setattr(ranking, "MAX_PARTS", 4)
    monkeypatch.setattr(ranking, "range_parts", lambda df, cols, n: asked.append(n) or parts(df, cols, n))
    df = spark.range(900).select(F.lit("k").alias("k"), (F.col("id") * 7 % 900).alias("v"), F.lit(2).alias("c"))
    got = {r["v"]: (r["cum_c"], r["next_value"]) for r in ranking.prefix_counts(df, "k", "v", ["c"], rows_per_bucket=10).collect()}
    assert asked == [4]
    assert got == {v: (2 * v + 2, v + 1 if v < 899 else None) for v in range(900)}
    monkeypatch.setattr(ranking, "PART_ROWS", 100)
    ranking.prefix_counts(df, "k", "v", ["c"], rows_per_bucket=10)
    assert asked == [4, 9]  # no part grows without bound


def test_explainers_are_compiled(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (None, 1.0, 2.0)], "id long, a double, b double")
    scorer = lambda x: 1.0 / (1.0 + F.exp(-(x["a"] + F.lit(2.0) * x["b"])))
    lime = explain.lime_tabular(df, "id", ["a", "b"], scorer, {"a": 1.0, "b": 1.0}, n_samples=20)
    shap = explain.sampled_shapley(df, df.where("id = 1"), "id", ["a", "b"], lambda x: x["a"] + F.lit(2.0) * x["b"], 4)
    assert "lambda" not in plan(lime) and "lambda" not in plan(shap)
    assert lime.count() == 4
    got = {(r["id"], r["feature"]): r["shap"] for r in shap.collect()}
    assert got[1, "a"] == got[1, "b"] == 0.0 and got[None, "a"] == -1.0 and got[None, "b"] == -2.0


def test_words_are_hashed_once_a_list(spark):
    df = spark.createDataFrame([(1, "a b a c")], "id long, t string")
    out = explain.lime_text(df, "id", "t", lambda w: F.size(w).cast("double"))
    assert plan(out).count("md5(") == 2  # the words, the distinct words
    assert {r["word"] for r in out.collect()} == {"a", "b", "c"}


def test_rows_of_a_file_are_dealt_by_count(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    cores = spark.sparkContext.defaultParallelism
    assert deal_small(df, rows=10).rdd.getNumPartitions() == 100
    assert deal_small(df).rdd.getNumPartitions() == cores


@pytest.mark.parametrize("kind,maker", [("random_forest", "forest"), ("gbt", "boosted")])
def test_trees_are_fitted_on_parts_of_one_size(spark, monkeypatch, kind, maker):
    """Rows that come in one large part and three small ones are dealt anew; none goes missing."""
    class Seen:
        def fit(self, df):
            return [len(x) for x in df.rdd.glom().collect()]
    monkeypatch.setattr(ml, maker, lambda *a, **kw: Seen())
    rows = spark.range(0, 90_000, 1, 1)
    for i in range(3):
        rows = rows.union(spark.range(i, i + 10, 1, 1))
    sizes = ml.train(rows, kind, "y")
    assert sum(sizes) == 90_030 and len(sizes) == min(spark.sparkContext.defaultParallelism, 4)
    assert max(sizes) - min(sizes) < 100
    assert ml.even_parts(rows, 1, 10_000).rdd.getNumPartitions() % spark.sparkContext.defaultParallelism == 0
    assert sum(ml.train(rows.limit(0), kind, "y")) == 0
