"""One query for each corpus operator over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.plans.tables import table

from . import bpe, fingerprint, html_text, lang_crf, minhash, near_vectors, packing, secrets, sql, toxicity, url_filter

#: The tokenizer files' package is looked up at run time; another rank file can be passed to the operators.
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def held_out(doc_id: str = "doc_id"):
    """Rows that no language model learns from."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = lang_crf.train(docs, ~held_out())
    held = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    return lang_crf.predict(held, model).select("doc_id", "held_out", "lang_pred", "score")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = [r.kind for r in secrets.BASE]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select("doc_id", *[count(k) for k in kinds], F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.predict(docs, model).drop("text")


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = fingerprint.compared(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select(
        F.col("id").alias("doc_id"), F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint.shown(F.col("anchors"), F.col("anchors_chars")).alias("fingerprint"), fingerprint.shown(F.col("edited_anchors"), F.col("edited_anchors_chars")).alias("edited_fingerprint"),
        "near_edited", "near_next", "aligned_edited",
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), width=2)


def queries() -> dict:
    return {f.__name__: f for f in (op1_url_filter, op2_byte_bpe, op3_language, op4_secrets, op5_toxicity, op6_near_vectors, op7_html_text, op8_fingerprint, op9_packing, op10_minhash)}


def oracle_sql() -> dict[str, str]:
    """Where SQL can't express a query (tokens, learned models, hashes, dynamic programmes), its test compares it with brute force."""
    return {"op1_url_filter": sql.url_rules(), "op4_secrets": sql.secret_spans(), "op6_near_vectors": sql.near_vectors(), "op10_minhash": sql.near_documents()}
