"""Queries against their SQL on the smallest tables."""

import duckdb
import pytest

from sievemark.llm import catalogue

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, name):
    c = duckdb.connect()
    for t in "documents embeddings pages labels".split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    want = c.sql(catalogue.oracle_sql()[name])
    got = catalogue.queries()[name](spark, DIR)
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
