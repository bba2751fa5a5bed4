import pytest
from pyspark.sql import functions as F

from sievemark.plans.tables import cut


@pytest.fixture
def session(spark):
    """Small partitions are not merged."""
    s = spark.newSession()
    s.conf.set("spark.sql.shuffle.partitions", "64")
    s.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    return s


def test_small_tables_in_few_files(session):
    """Of a small table not every shuffle partition becomes a file; the rows stay the same."""
    rows = cut(session.range(4000).withColumn("k", F.col("id") % 500))
    grouped = rows.groupBy("k").agg(F.sum("id").alias("n"))
    written = cut(grouped)
    assert len(written.inputFiles()) <= 2 * session.sparkContext.defaultParallelism
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, grouped.collect())) and written.count() == 500
    assert cut(grouped.limit(0)).count() == 0


def test_rows_that_differ_between_runs_are_not_dealt_out(session):
    rows = cut(session.range(4000).withColumn("k", F.col("id") % 500)).groupBy("k").count()
    numbered = cut(rows.withColumn("id", F.monotonically_increasing_id()))
    assert len(numbered.inputFiles()) > 2 * session.sparkContext.defaultParallelism
    assert numbered.select("id").distinct().count() == 500


def test_partitions_stay_where_much_is_read_or_spark_merges(session, monkeypatch):
    rows = cut(session.range(4000).withColumn("k", F.col("id") % 500)).groupBy("k").count()
    monkeypatch.setattr("sievemark.plans.tables.FILE_BYTES", 100)
    assert len(cut(rows).inputFiles()) > 2 * session.sparkContext.defaultParallelism
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(cut(rows).inputFiles()) <= session.sparkContext.defaultParallelism
