from collections import Counter

import corpus_pipeline as P
from sievemark.llm import packing, secrets

from .test_minhash import brute as groups
from .test_packing import whole
from .test_secrets import brute as spans
from .texts import odd_rows

DIR = "/root/testdata/sf0.01"


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    before, columns = docs.collect(), docs.columns
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, spark.createDataFrame(before, docs.schema), DIR)
        assert out.columns == columns
        after, was = out.collect(), {r["doc_id"]: r for r in before}
        ids = {r["doc_id"] for r in after}
        assert len(ids) == len(after) <= len(was)
        if name == "secrets":
            assert ids == set(was)
            for r in after:
                found = spans(was[r["doc_id"]]["text"], secrets.RULES)
                assert (r["text"] == was[r["doc_id"]]["text"]) == (not found) and r["n_chars"] == (len(r["text"]) if found else was[r["doc_id"]]["n_chars"])
                assert not spans(r["text"], secrets.RULES) or "=" in r["text"]
        else:
            assert all(r == was[r["doc_id"]] for r in after)
        if name == "language":
            assert len(after) >= 0.97 * len(before)
        if name == "toxicity":
            assert 0 < len(before) - len(after) < 0.2 * len(before)
            assert sum(labels.get(i) == 0 for i in set(was) - ids) <= 0.02 * len(before)
        if name == "near_duplicates":
            assert ids == {c for _, _, c in groups([(r["doc_id"], r["text"]) for r in before], 5)}
        before = after
    rows = P.pack(spark, spark.createDataFrame(before, docs.schema), DIR).collect()
    whole(rows, [(r["doc_id"], len(r["text"].encode().split())) for r in before], packing.LONGEST, packing.BUDGET)
    # run() is these stages, one after the other, over the whole table.
    assert Counter(map(tuple, P.run(spark, DIR).collect())) == Counter(map(tuple, rows))


def test_odd_rows_and_empty_tables(spark):
    df = spark.createDataFrame([r[:5] for r in odd_rows()], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in P.STAGES:
        assert stage(spark, df.limit(0), DIR).count() == 0
        assert stage(spark, df, DIR).count() > 0
    kept = Counter((r["doc_id"], r["text"]) for r in P.near_duplicates(spark, df, DIR).collect())
    assert max(kept.values()) == 1 and sum(n for (d, _), n in kept.items() if d is None) == 1


def test_mixed_languages_stay(spark):
    """A document in three known languages stays; one without letters goes."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    parts = [r["t"] for r in docs.filter("lang is not null and n_chars between 300 and 3000").groupBy("lang").agg({"text": "min"}).toDF("lang", "t").orderBy("lang").collect()]
    mixed = " ".join(p[:300] for p in parts)
    more = spark.createDataFrame([(10**9, mixed, None, None, len(mixed)), (10**9 + 1, "123 --- ½", None, None, 9)], docs.schema)
    kept = {r["doc_id"] for r in P.language(spark, docs.union(more), DIR).collect()}
    assert 10**9 in kept and 10**9 + 1 not in kept
