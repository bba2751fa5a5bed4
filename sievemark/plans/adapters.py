"""Detection tables derived from the driver's business tables.

The texts are in the dialect that Spark and DuckDB share and use whole-number
arithmetic, so both engines derive the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievemark.plans.tables import table
from sievemark.sources import config

#: One box for each line item; role 0: predictions, 1: verifier, 2: labels.
BOXES = """
SELECT image, split, class_id, role, mode, conf, cx, cy, w, h, defect,
  row_number() OVER (PARTITION BY image ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, cents, l_shipdate, l_quantity) AS idx
FROM (SELECT cast(floor(l_orderkey / 8) AS bigint) AS image,
    CASE cast(floor(l_orderkey / 8) AS bigint) % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split,
    cast(l_linenumber % 6 AS int) AS class_id, cast(l_suppkey % 3 AS int) AS role,
    CASE WHEN l_orderkey % 3 = 0 THEN 'review' ELSE 'auto' END AS mode,
    cast(round(l_extendedprice * 100) AS bigint) % 1001 / 1e3 AS conf,
    (300 + (l_partkey % 3) * 50) / 1e3 AS cx, (300 + (l_suppkey % 5) * 50) / 1e3 AS cy,
    (200 + (cast(l_quantity AS bigint) % 5) * 20) / 1e3 AS w, (200 + (cast(l_quantity AS bigint) % 7) * 20) / 1e3 AS h,
    l_partkey % 40 AS defect, cast(round(l_extendedprice * 100) AS bigint) AS cents,
    l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_quantity
  FROM lineitem) AS l
"""
#: The default thresholds by class number.
THRESHOLDS = [(i, *limits) for i, limits in enumerate(config.THRESHOLDS.values())]
#: Label lines with faults put in by the part's number.
LINES = f"""
SELECT split, image AS file, idx AS line_no, CASE defect
  WHEN 0 THEN '1 0.5 0.5 0.2' WHEN 1 THEN 'x 0.5 0.5 0.2 0.2' WHEN 2 THEN '1 nan 0.5 0.2 0.2' WHEN 3 THEN '1.5 0.5 0.5 0.2 0.2' WHEN 4 THEN '9 0.5 0.5 0.2 0.2'
  WHEN 5 THEN '1 0.5 0.5 1.5 0.2' WHEN 6 THEN '1 0.05 0.5 0.2 0.2' WHEN 7 THEN '1 0.5 0.5 -0.2 0.2' WHEN 8 THEN '  '
  ELSE concat(cast(class_id AS string), '  0.', cast(300 + defect % 3 * 50 AS string), ' 0.5 0.2 0.2 ') END AS value
FROM ({BOXES}) AS b WHERE role = 2
"""
REVIEWED = "SELECT lang AS class_name, n_chars * 37 % 1000 / 1e3 AS conf, quality = 1 AS accepted FROM documents JOIN labels ON documents.doc_id = labels.doc_id WHERE quality IS NOT NULL"


def sql(spark: SparkSession, sf_dir: str, text: str, *tables: str) -> DataFrame:
    for t in tables:
        table(spark, sf_dir, t).createOrReplaceTempView(t)
    return spark.sql(text)


def boxes(spark: SparkSession, sf_dir: str, role: int) -> DataFrame:
    return sql(spark, sf_dir, BOXES, "lineitem").filter(f"role = {role}").drop("role", "defect")


def thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(THRESHOLDS, "class_id int, auto_thr double, review_thr double")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, sf_dir, LINES, "lineitem")


def reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, sf_dir, REVIEWED, "documents", "labels")
