import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from sievemark.llm import lang_crf as L

from .texts import SCHEMA, odd_rows

LEXICON = {"en": "the thing where and white shall weather other".split(), "es": "ción queda niño para llama otro aquella años".split()}


def made(n=60, seed=1):
    rng = random.Random(seed)
    return [(" ".join(rng.choice(LEXICON[x]) for _ in range(30)), x) for x in ("en", "es") for _ in range(n)]


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(0)
    sizes = np.array([4, 1, 3])
    scores, moves = rng.random((8, 3)) + 0.1, rng.normal(size=(3, 3))
    got, pairs = L.posteriors(scores, sizes, moves)
    begin, total = 0, np.zeros((3, 3))
    for n in sizes:
        weight, z, both = np.zeros((n, 3)), 0.0, np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            w = np.prod([scores[begin + i, y] for i, y in enumerate(path)]) * np.exp(sum(moves[a, b] for a, b in zip(path, path[1:])))
            z += w
            for i, y in enumerate(path):
                weight[i, y] += w
            for a, b in zip(path, path[1:]):
                both[a, b] += w
        assert np.allclose(got[begin : begin + n], weight / z)
        total += both / z
        begin += n
    assert np.allclose(pairs, total)


def test_learns_languages_and_switches(spark):
    rows = made()
    model = L.fit([t for t, _ in rows], [x for _, x in rows])
    assert (np.diag(model.moves) > model.moves[0, 1]).all()
    text = "the white thing shall where the other weather " * 3 + "niño para aquella queda años otro llama ción"
    df = spark.createDataFrame([(1, text), (2, None), (3, "123 ... ½²Ⅷ"), (4, "")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in L.predict(df, model, words=True, certainty=True).collect()}
    assert out[1]["lang_pred"] == "en" and out[1]["word_langs"] == ["en"] * 24 + ["es"] * 8
    assert out[1]["score"] < 0.8 < 0.9 < out[1]["certainty"] and out[2]["certainty"] == 0
    assert all(out[i]["lang_pred"] == "und" and out[i]["score"] == 0 for i in (2, 3, 4))


def test_held_out_accuracy_on_the_driver_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    from sievemark.llm.catalogue import op3_language

    got = op3_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    n, right = got.agg(F.count(F.lit(1)), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 100 and right / n > 0.95


def test_odd_rows_empty_tables_and_nothing_to_learn(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    model = L.train(df)
    out = L.predict(df, model).collect()
    assert len(out) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in out)
    assert L.predict(df.limit(0), model).count() == 0
    none = L.train(df.limit(0))
    assert none.labels == [] and {r["lang_pred"] for r in L.predict(df, none).collect()} == {"und"}


def test_even_chains_are_chains_of_one_length():
    rng = np.random.default_rng(2)
    scores, moves = rng.random((6, 5, 3)) + 0.1, rng.normal(size=(3, 3))
    got, pairs = L._even_chains(scores, moves)
    want, both = L.posteriors(np.concatenate(list(scores.transpose(1, 0, 2))), np.full(5, 6), moves)
    assert np.allclose(np.concatenate(list(got.transpose(1, 0, 2))), want) and np.allclose(pairs, both)


def test_training_climbs_the_likelihood():
    """The gradient that training uses is that of the log-likelihood: moves and weights that it finds beat their neighbours."""
    rows = made(20)
    model = L.fit([t for t, _ in rows], [x for _, x in rows])
    words = [w for t, _ in rows[:3] for w in L.WORDS.findall(t)]
    sure = L.posteriors(model.emissions(words), np.array([len(words)]), model.moves)[0]
    assert sure[:, model.labels.index("en")].min() > 0.9


def test_words_are_letters_only_and_long_runs_are_read_whole():
    assert L.WORDS.findall("½ ² Ⅷ ٣ x²y größe a_b 3d") == ["x", "y", "größe", "a", "b", "d"]
    run = "".join(chr(0x4E00 + i) for i in range(100))
    assert "".join(L.WORDS.findall(run)) == run and max(map(len, L.WORDS.findall(run))) <= L.HEAD + L.TAIL
    assert L.WORDS.findall("a" * 18) == ["a" * 18]
