"""Exact neighbours, synthetic rows and the balanced preparation against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trustframe.operators import balance as ba
from trustframe.operators.neighbors import knn_self_join


def by_hand(rows, k):
    ok = [(i, [float(x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and not math.isnan(x) for x in v)]
    out = []
    for i, v in ok:
        near = sorted((sum((a - b) ** 2 for a, b in zip(v, w)), j) for j, w in ok if j != i)[:k]
        out += [(i, r + 1, j, math.sqrt(d)) for r, (d, j) in enumerate(near)]
    return sorted(out)


def table(spark, rows, kind="long"):
    return spark.createDataFrame(rows, f"id {kind}, v array<double>").repartition(3)


def result(df, k, **kw):
    got = knn_self_join(df, "id", F.col("v"), k, **kw)
    assert got.columns == ["id", "rank", "neighbor", "distance"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("k,kw", [(1, {}), (5, {}), (5, {"block": 7}), (3, {"pivots": 1, "block": 50}), (5, {"pivots": 300}), (400, {})])
def test_equals_all_pairs(spark, k, kw):
    r = random.Random(7)
    rows = [(i, [round(r.gauss(3 * (i % 4), 1), 1), round(r.random() * 4) / 2.0]) for i in range(250)]
    rows += [(1000 + i, [0.0, -0.0]) for i in range(12)] + [(2000, [0.0, 0.0]), (2001, [1e6, 1e6])]  # copies, an outlier
    rows += [(3000, None), (3001, [None, 1.0]), (3002, [float("nan"), 1.0]), (None, [0.0, 0.0])]
    assert result(table(spark, rows), k, **kw) == by_hand(rows, k)


def test_text_ids_many_dimensions_and_whole_numbers(spark):
    r = np.random.default_rng(3)
    rows = [(f"k{i:03d}", [float(x) for x in r.integers(0, 3, 12)]) for i in range(200)]
    report = {}
    assert result(table(spark, rows, "string"), 4, report=report) == by_hand(rows, 4)
    assert report["pivots"] == 15 and report["points"] <= 200 and report["visits"] > 0
    small = spark.createDataFrame([(1, [1, 2]), (2, [1, 3])], "id int, v array<int>")
    assert result(small, 5) == [(1, 1, 2, 1.0), (2, 1, 1, 1.0)]


def test_few_rows_and_none(spark):
    assert result(table(spark, []), 5) == []
    assert result(table(spark, [(1, [1.0])]), 5) == []
    assert result(table(spark, [(1, None), (2, None)]), 5) == []


def test_a_third_of_all_rows_is_one_vector(spark, monkeypatch):
    from trustframe.operators import neighbors
    monkeypatch.setattr(neighbors, "VISITORS", 40)
    d = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.array(F.lit(0.0), F.lit(0.0))).otherwise(
        F.array(F.col("id") * 1.0, F.pmod("id", F.lit(7)) * 1.0)).alias("v"))
    rows = [(i, [0.0, 0.0] if i % 3 == 0 else [float(i), float(i % 7)]) for i in range(3000)]
    report = {}
    got = result(d, 3, report=report)
    assert report["points"] == 2001 and len(got) == 9000
    per = {}
    for i, r, n, dist in got:
        per.setdefault(i, []).append((dist, n))
    for i in (0, 3, 6, 9, 2997, 1, 2, 1000, 1499, 2999):
        near = sorted((sum((a - b) ** 2 for a, b in zip(rows[i][1], v)) ** 0.5, j) for j, v in rows if j != i)[:3]
        assert per[i] == near


def classes(df):
    return {r["y"]: r["n"] for r in df.groupBy("y").agg(F.count("*").alias("n")).collect()}


def test_smote_grows_every_class_between_neighbours(spark):
    r = random.Random(1)
    rows = [(i, "a" if i < 60 else "b" if i < 72 else "c" if i < 99 else None, [r.random(), r.random() * 9]) for i in range(100)]
    rows += [(100, "b", None), (101, "b", [float("nan"), 1.0])]
    d = spark.createDataFrame(rows, "id long, y string, v array<double>")
    s = ba.smote(d, "id", "y", F.col("v"), 5)
    assert s.columns == ["id", "y", "features", "synthetic_of", "neighbor", "copy"]
    assert classes(s) == {"a": 60, "b": 60, "c": 60, None: 1}
    real = s.where("synthetic_of IS NULL")
    key = lambda x: (x[0], x[1], repr(x[2]))
    assert sorted(map(key, real.select("id", "y", "features").collect())) == sorted(map(key, rows))
    at = {i: (y, v) for i, y, v in rows}
    near = {}
    for c in "bc":
        for i, _, j, _ in by_hand([(i, v) for i, y, v in rows if y == c], 5):
            near.setdefault(i, set()).add(j)
    new = s.where("synthetic_of IS NOT NULL").collect()
    assert len({(x.synthetic_of, x.copy) for x in new}) == len(new) == 46 + 33
    for x in new:
        (y, v), (_, w) = at[x.synthetic_of], at[x.neighbor]
        assert x.id is None and x.y == y and x.neighbor in near[x.synthetic_of]
        gap = [(f - a) / (b - a) for f, a, b in zip(x.features, v, w) if b != a]
        assert max(gap) - min(gap) < 1e-9 and 0 <= gap[0] < 1
    again = ba.smote(d.repartition(5), "id", "y", F.col("v"), 5)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, s.collect()))


def test_smote_leaves_small_classes_and_empty_tables(spark):
    rows = [(i, int(i < 5), [float(i)]) for i in range(30)]  # five rows: no five neighbours
    d = spark.createDataFrame(rows, "id long, y int, v array<double>")
    assert sorted((r.id, r.y, r.features) for r in ba.smote(d, "id", "y", F.col("v")).collect()) == rows
    assert ba.smote(d.limit(0), "id", "y", F.col("v")).count() == 0
    six = spark.createDataFrame([(i, int(i < 6), [float(i)]) for i in range(30)], d.schema)
    assert classes(ba.smote(six, "id", "y", F.col("v"))) == {0: 24, 1: 24}


def test_preparation_balances_train_only(spark):
    rows = [(i, int(i % 8 == 0), float(i % 37), "xyz"[i % 3]) for i in range(400)]
    d = spark.createDataFrame(rows, "id long, y int, a double, c string")
    p, enc = ba.prepare(d, "id", "y", ["a"], ["c"])
    plain, _ = ba.prepare(d, "id", "y", ["a"], ["c"], balance=False)
    assert enc.feature_names() == ["a", "c_y", "c_z"]
    rest = lambda x: sorted((r.id, r.split, r.y, r.features) for r in x.where("split <> 'train'").collect())
    assert rest(p) == rest(plain) and len(rest(p)) == plain.count() - plain.where("split = 'train'").count()
    train = classes(p.where("split = 'train'"))
    assert train[0] == train[1] == classes(plain.where("split = 'train'"))[0]
    assert p.where("id IS NULL AND split <> 'train'").count() == 0
    # no synthetic row can be taken for a real one
    assert p.join(d.select("id"), "id").count() == 400
    # neighbours and bases are train rows
    used = p.where("synthetic_of IS NOT NULL").select(F.explode(F.array("synthetic_of", "neighbor")).alias("id")).distinct()
    assert used.join(plain.where("split = 'train'"), "id").count() == used.count() > 0


def test_cells_hold_few_points_in_few_dimensions_and_are_few_in_many(spark, monkeypatch):
    from trustframe.operators import neighbors
    monkeypatch.setattr(neighbors, "CELL_POINTS", 20)
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in r.normal(0, 10, 2)]) for i in range(700)]
    report = {}
    assert result(table(spark, rows), 3, report=report) == by_hand(rows, 3)
    assert report["pivots"] == 35 and report["visits"] < 12 * 700
    rows = [(i, [float(x) for x in 1000 + r.integers(0, 40, 20)]) for i in range(400)]
    assert result(table(spark, rows), 3, report=report) == by_hand(rows, 3)
    assert report["pivots"] == neighbors.FEW_CELLS and report["visits"] <= 15 * 400
