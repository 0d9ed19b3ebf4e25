"""Property tests (hypothesis) for the two shared helpers against their plain
single-window definitions, on random sizes, skew and ties."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trustframe.operators import ranking

SETTINGS = dict(max_examples=6, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(sizes=st.lists(st.integers(1, 400), min_size=1, max_size=4),
       share=st.sampled_from([0.05, 0.2, 0.5, 0.9]), seed=st.integers(0, 99),
       digits=st.sampled_from([1, 2, None]))
def test_rank_segments_equals_row_number(spark, sizes, share, seed, digits):
    rows, k = [], 0
    for g, n in enumerate(sizes):
        for _ in range(n):
            rows.append((k, f"g{g}"))
            k += 1
    df = spark.createDataFrame(rows, "id long, g string")
    got = ranking.rank_segments(df, ["g"], "id", seed, lambda N: [ranking.ceil_share(N, share)],
                                ["a", "b"], digits=digits)
    w = Window.partitionBy("g").orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))),
                                        "id")
    cut = ranking.ceil_share(F.count("*").over(Window.partitionBy("g")), share)
    ref = df.withColumn("segment", F.when(F.row_number().over(w) <= cut, "a").otherwise("b"))
    assert sorted((r.id, r.segment) for r in got.collect()) == \
        sorted((r.id, r.segment) for r in ref.collect())


@settings(**SETTINGS)
@given(values=st.lists(st.tuples(st.sampled_from(["x", "y"]), st.integers(-50, 50),
                                 st.integers(1, 9)), min_size=1, max_size=300),
       rows_per_bucket=st.sampled_from([3, 17, 100000]))
def test_prefix_counts_equals_running_sum(spark, values, rows_per_bucket):
    agg = {}
    for k, v, c in values:
        agg[(k, float(v))] = agg.get((k, float(v)), 0) + c
    df = spark.createDataFrame([(k, v, c) for (k, v), c in agg.items()], "k string, v double, c long")
    got = ranking.prefix_counts(df, "k", "v", ["c"], rows_per_bucket=rows_per_bucket)
    w = Window.partitionBy("k").orderBy("v")
    ref = df.select("k", "v", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_c"),
                    F.lead("v").over(w).alias("next_value"))
    assert sorted((r.k, r.v, r.cum_c, r.next_value) for r in got.collect()) == \
        sorted((r.k, r.v, r.cum_c, r.next_value) for r in ref.collect())
