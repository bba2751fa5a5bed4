"""Extra columns that bear a name which an operator uses inside pass through unchanged."""

import corpus_pipeline as P
import public_tokenizers
import pytest

from sievemark.llm import bpe, html_text, lang_crf, secrets, toxicity, url_filter

NAMES = ["key", "kinds", "kind", "spans_", "row", "text_hash", "id", "t", "u", "h", "p", "v", "best", "full", "prefix", "host_", "layouts", "model", "seen", "bucket", "component", "leader", "group", "g_id", "r_id", "at", "b", "place", "low", "__text", "__y", "__id", "__u", "__host", "__apart"]
EXTRA = ", ".join(f"{n} string" for n in NAMES)


@pytest.fixture(scope="module")
def docs(spark):
    texts = ["the white thing shall pass", "la niña aquella queda otro", "the other secret=abcdef123 thing", None, "the white thing shall pass"]
    rows = [(i, t, "en" if i % 2 else "es", "s", len(t or ""), *[f"{n}{i}" for n in NAMES]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars int, {EXTRA}")


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://a.example.net/en/{i}", f"<body><article>text {i}</article></body>", *[f"{n}{i}" for n in NAMES]) for i in range(4)]
    return spark.createDataFrame(rows, f"page_id long, url string, html string, {EXTRA}")


def same(df, out, key):
    assert set(NAMES) <= set(out.columns) and len(set(out.columns)) == len(out.columns)
    want = {r[key]: tuple(r[n] for n in NAMES) for r in df.collect()}
    got = [(r[key], tuple(r[n] for n in NAMES)) for r in out.collect()]
    assert got and all(want[k] == v for k, v in got)
    return len(got)


def test_pages(pages):
    assert same(pages, url_filter.judge(pages), "page_id") == 4
    assert same(pages, html_text.extract(pages), "page_id") == 4


def test_documents(docs):
    model = lang_crf.fit(["the white thing"] * 5 + ["la niña aquella"] * 5, ["en"] * 5 + ["es"] * 5)
    assert same(docs, lang_crf.predict(docs, model, words=True, certainty=True), "doc_id") == 5
    assert same(docs, toxicity.predict(docs, toxicity.fit(["bad"] * 9 + ["good"] * 9, [1] * 9 + [0] * 9)), "doc_id") == 5
    assert same(docs, bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN), "doc_id") == 5
    assert same(docs, secrets.scan(docs, carry=tuple(docs.columns)), "doc_id") == 5


def test_pipeline_stages(spark, docs):
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        same(docs, out, "doc_id")
    assert P.pack(spark, docs, "").count() == 4
