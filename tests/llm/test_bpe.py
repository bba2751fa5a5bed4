import public_tokenizers as P
import pytest
import tiktoken

from sievemark.llm import bpe

from .texts import SCHEMA, odd_rows

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(PATH).rank, special_tokens={})


def test_rows_encode_as_the_library_does(spark, reference):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    got = bpe.round_trip(df, PATH, P.PATTERN).select("doc_id", "ids", "decoded").collect()
    want = [(r[0], reference.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in rows]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r[0], list(r[1]), bytes(r[2])) for r in got), key=key) == sorted(want, key=key)
    assert bpe.round_trip(df.limit(0), PATH, P.PATTERN).count() == 0


def test_encode_then_decode(spark):
    df = spark.createDataFrame([(1, "déjà vu  twice\n"), (2, None)], "doc_id long, text string")
    assert {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode(bpe.encode(df, PATH, P.PATTERN), PATH).collect()} == {1: "déjà vu  twice\n".encode(), 2: b""}


def test_small_blocks_and_forgetting_change_nothing(reference, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_WORDS", 5)
    monkeypatch.setattr(bpe, "MANY", 2)
    coder = bpe.Encoder(PATH, P.PATTERN)
    for text in [r[1] or "" for r in odd_rows()]:
        ids, counts = coder.encode([text, text[:7]])
        assert ids.tolist() == reference.encode_ordinary(text) + reference.encode_ordinary(text[:7]) and counts.sum() == len(ids)


def test_lower_rank_made_by_a_later_merge_goes_first(tmp_path):
    import base64

    tokens = [bytes([i]) for i in range(256)] + [b"abc", b"bc", b"aa", b"aaa"]
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate(tokens)))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks(str(path)).rank, special_tokens={})
    for word in ("abcbc", "abc", "bcbcabc", "aaaaa", "aaaabcaaa"):
        assert bpe.replay([word.encode()], bpe.ranks(str(path)))[0] == own.encode_ordinary(word)
