"""CSV readers (S1-S3), registry (S4), cache (S6), model persistence."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from trustframe.sources import readers, sinks


def _write(text):
    d = tempfile.mkdtemp(prefix="tf-csv-")
    p = os.path.join(d, "data.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_headered_hr_csv(spark):
    p = _write("Age,Attrition,Gender,EmployeeCount,MonthlyIncome\n"
               "30,Yes,Male,1,5000\n40,No,Female,1,\n55,No,,1,7000\n29,Maybe,Female,1,6000\n")
    df = readers.read_headered_csv(spark, p)
    assert "EmployeeCount" not in df.columns
    rows = {r.Age: r for r in df.collect()}
    assert rows[30].Attrition == 1 and rows[40].Attrition == 0 and rows[29].Attrition is None
    assert rows[30].AgeBucket == "<30" and rows[40].AgeBucket == "30-40" and rows[55].AgeBucket == "50+"
    assert rows[40].MonthlyIncome == 6000  # median of 5000, 6000, 7000
    assert rows[55].Gender == "Female"     # mode


def test_fixed_adult_csv(spark):
    line = "39, State-gov, 77516, Bachelors, 13, Never-married, ?, Not-in-family, White, Male, 2174, 0, 40, United-States, <=50K\n"
    line2 = "50, ?, 83311, Bachelors, 13, Married, Exec, Husband, White, Male, 0, 0, 13, United-States, >50K\n"
    line3 = "38, Private, 215646, HS-grad, 9, Divorced, Exec, Not-in-family, White, Male, 0, 0, 40, United-States, >50K\n"
    df = readers.read_fixed_csv(spark, _write(line + line2 + line3))
    assert "fnlwgt" not in df.columns
    r = sorted(df.collect(), key=lambda x: x.age)
    assert [x.income for x in r] == [1, 0, 1]
    assert r[0].workclass == "Private" and r[1].occupation == "Exec"  # '?' imputed with the mode


def test_missing_clinical_file_is_typed_error(spark):
    with pytest.raises(readers.DataLoaderError):
        readers.read_required_csv(spark, "/nonexistent/clinical.csv")


def test_clinical_sparse_rows_and_unknown(spark):
    p = _write("subject_id,hadm_id,a,b,c,note,hospital_expire_flag\n"
               "1,1,1.0,2.0,3.0,,0\n2,2,,,,,1\n3,3,4.0,5.0,6.0,,1\n")
    df = readers.read_required_csv(spark, p)
    rows = df.collect()
    assert len(rows) == 2  # the row with 2 of 5 values is dropped (needs int(0.7*5) = 3)
    assert all(r.note == "Unknown" for r in rows)


def test_registry_unknown_dataset(spark):
    with pytest.raises(readers.DataLoaderError):
        readers.load_dataset(spark, "nope", {"data": {}})


def test_cached_result_reuses(spark):
    root = tempfile.mkdtemp(prefix="tf-cache-")
    calls = []

    def build():
        calls.append(1)
        return spark.range(5).withColumn("x", F.col("id") * 2)
    a = sinks.cached_result(spark, root, "/p", {"k": 1}, build).count()
    b = sinks.cached_result(spark, root, "/p", {"k": 1}, build).count()
    sinks.cached_result(spark, root, "/p", {"k": 2}, build)
    assert a == b == 5 and len(calls) == 2


def test_models_sanity(spark, sf):
    from trustframe.plans import models_q
    from trustframe.operators import metrics as mt
    from trustframe.operators import models as ml
    m, _, test = models_q._fit(spark, sf, "logistic_regression", c=1.0)
    rep = {r.feature: r.coefficient for r in ml.importance(spark, m, models_q.FEATS).collect()}
    assert rep["price"] > 0 and rep["days"] > 0
    assert mt.roc_auc(test, "y", "p").first().auc > 0.8
