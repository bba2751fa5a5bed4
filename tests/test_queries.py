"""Every query against its SQL on the smallest tables."""

import duckdb
import pytest

from sievemark import catalogue

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.12g}")
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, name):
    got = catalogue.queries()[name](spark, DIR)
    if name not in catalogue.oracle_sql():
        assert got.count() > 0
        return
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    want = c.sql(catalogue.oracle_sql()[name])
    assert sorted(want.columns) == sorted(got.columns)
    rows = sorted(map(plain, map(tuple, got.select(*want.columns).collect())), key=repr)
    assert rows == sorted(map(plain, want.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__ as e

    assert {"consensus_rollup"} <= set(e.queries()) and e.entry(spark).count() == 7
    assert set(e.oracle_sql()) <= set(e.queries())
