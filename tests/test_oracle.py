"""Every registered query against its DuckDB oracle on the small tables."""

import re

import pytest

import __spark_entry__ as E
from oracle import compare, duck

# the training-data queries have tests of their own
QUERIES = {k: v for k, v in E.queries().items() if not re.match(r"op\d+_|pipeline$", k)}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert len(ORACLE) >= 60


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf, name):
    got = QUERIES[name](spark, sf).toPandas()
    want = duck(sf).execute(ORACLE[name]).df()
    msg = compare(got, want)
    assert msg is None, msg


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, sf, name):
    df = QUERIES[name](spark, sf)
    assert df.count() >= 0
    assert len(df.columns) > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["attr", "unpriv_group", "metric", "value", "lo", "hi", "pass"]
