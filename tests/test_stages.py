"""Fitted stages in a pipeline, folds, weighted F1 and latency sketches."""

import random
import tempfile

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from trustframe.operators import monitor as mo
from trustframe.operators import stages as st


def test_imputer_fits_on_given_rows_only(spark):
    schema = "id int, a double, n int, c string, d double, part string"
    train = spark.createDataFrame([(1, 1.0, 1, "x", None, "t"), (2, 3.0, 2, "y", None, "t"), (3, None, None, "y", None, "t"), (4, float("nan"), 4, "x", None, "t")], schema)
    other = spark.createDataFrame([(5, None, None, None, None, "v"), (6, float("nan"), 7, "z", 1.0, "v"), (7, 100.0, 100, "q", None, "v")], schema)
    m = st.TableImputer(numericCols=["a", "n", "d"], categoricalCols=["c"]).fit(train)
    assert m.values() == {"a": 2.0, "n": 2.0, "c": "x", "d": None}  # no value of d: left alone
    got = m.transform(other)
    assert got.dtypes == other.dtypes
    assert sorted(map(tuple, got.collect())) == [(5, 2.0, 2, "x", None, "v"), (6, 2.0, 7, "z", 1.0, "v"), (7, 100.0, 100, "q", None, "v")]
    assert m.transform(other.limit(0)).count() == 0
    path = tempfile.mkdtemp(prefix="tf-imputer-") + "/m"
    m.save(path)
    assert st.TableImputerModel.load(path).values() == m.values()


def rows(spark, n=120):
    r = random.Random(2)
    data = [(i, r.gauss(0, 2), None if i % 9 == 0 else "abc"[i % 3], float(i % 3 == 0)) for i in range(n)]
    return spark.createDataFrame(data, "id int, a double, c string, y double")


def test_pipeline_round_trip_and_columns(spark):
    d = rows(spark)
    p = Pipeline(stages=[st.TableImputer(categoricalCols=["c"]), st.TableEncoder(numericCols=["a"], categoricalCols=["c"], outputCol="x"),
                         LogisticRegression(featuresCol="x", labelCol="y")])
    path = tempfile.mkdtemp(prefix="tf-pipe-")
    p.save(f"{path}/unfitted")
    m = Pipeline.load(f"{path}/unfitted").fit(d)
    m.save(f"{path}/fitted")
    again = PipelineModel.load(f"{path}/fitted")
    one, two = (sorted((r.id, r.probability[1]) for r in x.transform(d).collect()) for x in (m, again))
    assert one == two
    enc = again.stages[1]
    assert enc.encoder.feature_names() == ["a", "c_b", "c_c"] and enc.getOutputCol() == "x" and enc.uid == m.stages[1].uid
    assert again.stages[1].transform(d.where("c IS NOT NULL")).columns == ["id", "a", "c", "y", "x"]
    unseen = spark.createDataFrame([(1, enc.encoder.means["a"], "zzz", 0.0)], d.schema)
    assert list(enc.transform(unseen).first()["x"].toArray()) == [0.0, 0.0, 0.0]


def test_folds_are_exact_and_refit_without_their_rows(spark):
    d = rows(spark, 97).withColumn("odd", F.when(F.col("id") < 5, "few").otherwise("many"))
    f = st.stratified_folds(d, ["odd", "y"], "id", 4)
    assert f.count() == 97 and f.schema["fold"].dataType.simpleString() == "int"
    per = f.groupBy("odd", "y").pivot("fold", [0, 1, 2, 3]).count().na.fill(0).collect()
    for r in per:
        sizes = [r[str(i)] for i in range(4)]
        assert max(sizes) - min(sizes) <= 1
    # a category of one fold alone is unknown to the encoder fitted without it
    only = f.withColumn("c", F.when(F.col("fold") == 2, F.lit("only2")).otherwise(F.coalesce("c", F.lit("a"))))
    seen = []

    class Spy(st.TableEncoder):
        def _fit(self, df):
            m = super()._fit(df)
            seen.append(sorted(m.encoder.categories["c"]))
            return m
    p = Pipeline(stages=[Spy(numericCols=["a"], categoricalCols=["c"]), LogisticRegression(labelCol="y")])
    s = st.fold_scores(only, p, "fold", "y", "id")
    assert sorted(r.id for r in s.collect()) == list(range(97))
    assert [("only2" in x) for x in seen] == [True, True, False, True]


def test_weighted_f1_by_hand(spark):
    s = spark.createDataFrame([(0, 1.0, 1.0), (0, 1.0, 0.0), (0, 0.0, 0.0), (0, 0.0, 0.0), (1, 0.0, 1.0)], "fold int, y double, prediction double")
    got = {r.fold: r.f1_weighted for r in st.weighted_f1(s, "y", ["fold"]).collect()}
    assert got[0] == pytest.approx((2 / 3 * 2 + 4 / 5 * 2) / 4) and got[1] == 0.0


def test_sketches_merge_to_the_ranks_of_all_rows(spark):
    n = 60_000
    log = spark.range(n).select(F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(F.col("id") * 37, F.lit(48 * 3600))).alias("ts"),
                                F.when(F.col("id") % 1000 != 7, F.pow((F.col("id") * 7919) % n / n, 3)).alias("ms"))
    h = mo.latency_sketches(log, "ts", "ms")
    assert h.count() == 48
    est = mo.latency_percentiles(h, [0.0, 0.25, 0.5, 0.99, 1.0]).collect()
    assert len(est) == 10
    day = log.select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "ms").where("ms IS NOT NULL").toPandas()
    for e in est:
        v = day[day.day == e.day].ms
        assert e.n == len(v)
        assert (v < e.estimate).mean() - mo.SKETCH_ERROR <= e.q <= (v <= e.estimate).mean() + mo.SKETCH_ERROR
    assert mo.latency_percentiles(mo.latency_sketches(log.limit(0), "ts", "ms"), [0.5]).count() == 0
