import random

import numpy as np
from pyspark.sql import functions as F

from sievemark.llm import toxicity as X

from .texts import SCHEMA, odd_rows, prose

RUDE = "grobian lump depp".split()


def made(n=400, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words, bad = prose(rng, rng.randrange(5, 80)).split(), i % 6 == 0
        if bad:
            for _ in range(rng.choice([1, 2, 5])):
                words.insert(rng.randrange(len(words)), rng.choice(RUDE).upper() + "!")
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_held_out_accuracy_and_order_of_the_chain(spark):
    rows = made()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if r[0] % 2 == 0] + [(None, 1), (2, None)], "doc_id long, toxic int")
    model = X.train(docs, labels)
    assert set(RUDE) <= model.markers and [len(w) for w in model.weights] == [len(model.words) + 2 + i for i in range(3)]
    out = {r["doc_id"]: r for r in X.predict(docs, model).collect()}
    assert all(out[i]["is_toxic"] == bool(bad) for i, _, bad in rows if i % 2)
    sustained = [out[i]["p_sustained"] for i, t, bad in rows if sum(t.count(w.upper()) for w in RUDE) >= 5]
    assert min(sustained) > 0.5 > max(out[i]["p_sustained"] for i, _, bad in rows if not bad)


def test_driver_table_held_out(spark):
    """Labels of a fifth of the documents are not learned from."""
    from sievemark.llm.catalogue import held_out

    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    model = X.train(docs.select("doc_id", "text"), labels.filter(~held_out()))
    unseen = docs.join(labels.filter(held_out() & F.col("toxic").isNotNull()), "doc_id").select("doc_id", "text", "toxic")
    got = X.predict(unseen, model).select("toxic", "is_toxic").collect()
    bad = [r["is_toxic"] for r in got if r["toxic"] == 1]
    clean = [r["is_toxic"] for r in got if r["toxic"] == 0]
    assert len(bad) > 50 and np.mean(bad) > 0.8 and np.mean(clean) < 0.02


def test_folds_never_see_their_own_documents(monkeypatch):
    """Words, markers and targets of a fold come from the others: a document's own label cannot make its words markers."""
    seen = []
    chosen = X.Corpus.chosen
    monkeypatch.setattr(X.Corpus, "chosen", lambda self, rows: seen.append(rows.copy()) or chosen(self, rows))
    rows = made(120)
    X.fit([r[1] for r in rows], [r[2] for r in rows])
    assert seen[0].all() and len(seen) == 1 + X.FOLDS and (np.sum([~r for r in seen[1:]], axis=0) == 1).all()
    corpus = X.Corpus([r[1] for r in rows], [r[2] for r in rows])
    some = np.arange(len(corpus.y)) % 3 > 0
    alone = X.Corpus([r[1] for r, ok in zip(rows, some, strict=True) if ok], [r[2] for r, ok in zip(rows, some, strict=True) if ok])
    a, b = corpus.chosen(some), alone.chosen(np.ones(len(alone.y), dtype=bool))
    assert set(corpus.names[a[1]]) == set(alone.names[b[1]]) and set(corpus.names[a[0]]) == set(alone.names[b[0]])


def test_features_in_training_are_those_of_prediction():
    rows = made(80)
    texts, y = [r[1] for r in rows], [r[2] for r in rows]
    corpus, model = X.Corpus(texts, y), X.fit(texts, y)
    words, marks = corpus.chosen(np.ones(len(corpus.y), dtype=bool))
    assert np.array_equal(corpus.features(words, marks)[0], model.features(list(dict.fromkeys(texts))))


def test_one_text_for_an_id_and_ids_of_text(spark):
    docs = spark.createDataFrame([(f"d{i}", t) for i, t, _ in made(60)] * 2 + [("d0", f"text {i}") for i in range(200)], "doc_id string, text string")
    labels = spark.createDataFrame([(f"d{i}", y) for i, _, y in made(60)], "doc_id string, toxic int")
    collected = []
    fit = X.fit
    X.fit = lambda texts, y: collected.append(len(texts)) or fit(texts, y)
    try:
        assert X.train(docs, labels).weights
    finally:
        X.fit = fit
    assert collected == [60]


def test_driver_table(spark):
    from sievemark.llm.catalogue import op5_toxicity

    d = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    got = op5_toxicity(spark, d).collect()
    assert len(got) == 10_000
    flagged = np.mean([r["is_toxic"] for r in got])
    clean = [r for r in got if labels.get(r["doc_id"]) == 0]
    bad = [r for r in got if labels.get(r["doc_id"]) == 1]
    assert 0.05 < flagged < 0.15 and np.mean([r["is_toxic"] for r in clean]) < 0.02 and np.mean([r["is_toxic"] for r in bad]) > 0.8


def test_odd_rows_and_nothing_to_learn(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    model = X.fit([r[1] for r in made()], [r[2] for r in made()])
    out = X.predict(df, model).collect()
    assert len(out) == len(odd_rows()) and not any(r["is_toxic"] for r in out) and all(0 <= r["p_toxic"] <= 1 for r in out)
    assert X.predict(df.limit(0), model).count() == 0
    none = X.train(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert not none.weights and not any(r["is_toxic"] for r in X.predict(df, none).collect())
