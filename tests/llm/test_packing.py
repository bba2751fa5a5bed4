import itertools
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from sievemark.llm import packing as K
from sievemark.llm.catalogue import op9_packing

from .texts import SCHEMA, odd_rows


def padding(histogram, bounds):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in histogram.items())


def test_boundaries_against_every_choice():
    rng = random.Random(1)
    for _ in range(20):
        h = {x: rng.randrange(1, 50) for x in rng.sample(range(1, 60), 8)}
        for k in (1, 2, 3, 5):
            got = K.boundaries(h, k)
            best = min(padding(h, [*c, max(h)]) for j in range(k) for c in itertools.combinations(sorted(h)[:-1], j))
            assert len(got) <= k and padding(h, got) == best
    assert K.boundaries({}) == [] and K.boundaries({4: 1}, 9) == [4]


def whole(rows, texts, longest, budget):
    """Every token is packed once, batches are within budget, full but for each bucket's last, and slots are 0, 1, ..."""
    pieces = defaultdict(Counter)
    for r in rows:
        pieces[r["doc_id"]][r["piece"], r["n_tokens"]] += 1
    want = defaultdict(Counter)
    for doc, n in texts:
        for i in range(0, n, longest):
            want[doc][i // longest, min(longest, n - i)] += 1
    assert pieces == want
    batches = defaultdict(list)
    for r in rows:
        assert r["n_tokens"] <= r["bucket"]
        batches[r["bucket"], r["batch"]].append(r["slot"])
    last = {b: max(i for x, i in batches if x == b) for b, _ in batches}
    for (b, i), slots in batches.items():
        per = max(1, budget // b)
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= per and (len(slots) == per or i == last[b])


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(K, "PART", 4)
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    texts = [(r[0], len((r[1] or "").encode().split())) for r in odd_rows()]
    for longest, buckets, budget in ((64, 4, 256), (7, 3, 5)):
        whole(K.pack(df, longest=longest, buckets=buckets, budget=budget).collect(), texts, longest, budget)
    assert K.pack(df.limit(0)).count() == 0


def test_equal_rows_are_counted_and_dealt_out(spark, monkeypatch):
    """Rows without an id and of one length, more than a step holds, fill batches without gaps."""
    monkeypatch.setattr(K, "STEP", 7)
    df = spark.createDataFrame([(None, "a b c")] * 100 + [(5, "a b")] * 30 + [(6, "x " * 200)] * 3, "doc_id long, text string")
    whole(K.pack(df, longest=64, buckets=3, budget=16).collect(), [(None, 3)] * 100 + [(5, 2)] * 30 + [(6, 200)] * 3, 64, 16)


def test_lengths_of_a_tokenizer(spark):
    import public_tokenizers
    import tiktoken  # noqa: F401

    df = spark.createDataFrame([(1, "three little words"), (2, None), (3, "x" * 500)], "doc_id long, text string")
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    sized = K.token_lengths(df, path, pattern)
    n = {r["doc_id"]: r["n_tokens"] for r in sized.collect()}
    assert n[2] == 0 and 3 <= n[1] <= 8 and n[3] > 5
    rows = K.pack(sized, F.col("n_tokens"), longest=10).collect()
    whole(rows, [(d, x) for d, x in n.items()], 10, K.BUDGET)


def test_driver_table(spark):
    rows = op9_packing(spark, "/root/testdata/sf0.01").collect()
    texts = [(r["doc_id"], len(r["text"].encode().split())) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    whole(rows, texts, K.LONGEST, K.BUDGET)
    h = Counter(r["n_tokens"] for r in rows)
    assert sum(r["bucket"] - r["n_tokens"] for r in rows) == padding(h, K.boundaries(h)) <= 0.1 * sum(r["n_tokens"] for r in rows)
