"""The corpus pipeline: language, toxicity, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on every row that the one before kept,
and returns the columns of documents; the last returns the packing. ``run`` writes
each stage's rows as Parquet into the shared folder and reads them again.

Rows without an id are documents like any other; rows that share an id and not a text
are documents of their own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.llm import lang_crf, minhash, packing, secrets, toxicity
from sievemark.llm.catalogue import held_out
from sievemark.plans.tables import shared_dir, table

#: A document whose words' likeliest languages are less certain than this on average is rejected; und always is.
LEAST_CERTAINTY = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those whose words no language explains; mixed languages stay, and lang stays as it is."""
    model = lang_crf.train(docs, ~held_out())
    if not model.labels:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    judged = lang_crf.predict(_carried(docs), model, certainty=True)
    kept = judged.filter((F.col("lang_pred") != "und") & (F.col("certainty") >= LEAST_CERTAINTY))
    return kept.select("row.*")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the chain's last model calls toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.predict(_carried(docs), model).filter(~F.col("is_toxic")).select("row.*")


def _carried(docs: DataFrame) -> DataFrame:
    """Rows (row, text): the document's columns travel in one, so none of their names can clash."""
    return docs.select(F.struct(*docs.columns).alias("row"), "text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group, that with the smallest id."""
    return minhash.deduplicated(docs, width=5)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by its kind in brackets; the document stays."""
    return secrets.redact(docs, n_chars="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("language", language), ("toxicity", toxic), ("near_duplicates", near_duplicates), ("secrets", secret_scan), ("packing", pack)]

#: Learned models, redaction and the dynamic programme have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
