import hashlib
import re

import xxhash

from sievemark.llm import fingerprint as P
from sievemark.llm.catalogue import op8_fingerprint

from .texts import SCHEMA, odd_rows


def hashed(*values):
    """Spark's xxhash64 of byte strings or 64-bit numbers, one after the other."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v if isinstance(v, bytes) else v.to_bytes(8, "little", signed=True), seed=h)
    return h - 2**64 if h >> 63 else h


def brute_anchors(units):
    """Closed syncmers of hashes, by their definition: k units of which the smallest part of s stands first or last."""
    if len(units) < P.K:
        return [(1, hashed(" ".join(map(str, units)).encode()))] if units else []
    out = []
    for i in range(len(units) - P.K + 1):
        window = units[i : i + P.K]
        parts = [hashed(*window[j : j + P.S]) for j in range(P.K - P.S + 1)]
        if min(parts) in (parts[0], parts[-1]):
            out.append((i + 1, hashed(*parts)))
    return out


def brute_fingerprint(text):
    spaced = re.sub(P.UNSPACED.replace("\\x{20000}-\\x{3FFFF}", "\U00020000-\U0003ffff"), r" \g<0> ", text)
    words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", spaced) if w]
    units = [hashed(u.encode()) for w in words for u in (w if len(w) > P.LONG else [w])]
    chars = list(re.sub(r"[ \t\n\x0b\f\r]+", " ", text).strip(" ")) if len(text) <= P.SHORT else []
    return brute_anchors(units), brute_anchors([hashed(c.encode()) for c in chars])


def brute_likeness(a, b):
    x, y = ({h for _, h in f[1]} for f in (a, b)) if a[1] and b[1] else ({h for _, h in f[0]} for f in (a, b))
    return len(x & y) / len(x | y) if x | y else 1.0


def shown(f):
    return ",".join(f"{c}{p}:{h & (2**64 - 1):x}".upper().lower() for c, part in (("", f[0]), ("c", f[1])) for p, h in part)


def edited(rows):
    """Each (id, text) with its edited text, by one sort."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashed(r[1].encode()), r[1].encode()))
    out = []
    for i, (doc, text) in enumerate(ordered):
        half = len(text) // 2
        out.append((doc, text, text[: len(text) - half] + ordered[(i + 1) % len(ordered)][1][:half], ordered[(i + 1) % len(ordered)][1]))
    return out


def test_neighbours_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(P, "BUCKET_ROWS", 3)
    rows = [(r[0], r[1] or "") for r in odd_rows()]
    got = P.compared(spark.createDataFrame(odd_rows(), SCHEMA)).collect()
    assert sorted(((r["id"] is not None, r["id"] or 0, r["text"], r["edited"]) for r in got)) == sorted((d is not None, d or 0, t, e) for d, t, e, _ in edited(rows))
    by_text = {}
    for r in got:
        by_text.setdefault(r["text"], set()).add(str(r["anchors"]))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 and (r["near_edited"] == 1 or r["edited"] != r["text"])
    assert all(len(x) == 1 for x in by_text.values())


def test_driver_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    want = {d: (len(t), hashlib.sha256(e.encode()).hexdigest(), n == t) for d, t, e, n in edited(rows)}
    got = op8_fingerprint(spark, "/root/testdata/sf0.01").collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == {d: x[:2] for d, x in want.items()}
    assert all(r["near_next"] == 1 for r in got if want[r["doc_id"]][2])
    by_id = {r["doc_id"]: r for r in got}
    for d, t, e, n in edited(rows):
        own, after, following = brute_fingerprint(t), brute_fingerprint(e), brute_fingerprint(n)
        assert (by_id[d]["fingerprint"], by_id[d]["edited_fingerprint"]) == (shown(own), shown(after))
        assert abs(by_id[d]["near_edited"] - brute_likeness(own, after)) < 1e-12 and abs(by_id[d]["near_next"] - brute_likeness(own, following)) < 1e-12
    long = [r for r in got if r["n_chars"] > 1000]
    assert sum(r["near_edited"] for r in long) / len(long) > 0.25 and sorted(r["near_next"] for r in long)[len(long) // 2] < 0.05


def test_windows_are_kept_by_their_own_words(spark):
    words = [f"w{i}" for i in range(200)]
    df = spark.createDataFrame([(0, " ".join(words)), (1, " ".join(["new"] * 7 + words)), (2, "a b"), (3, "")], "id long, text string")
    out = {r["id"]: [(a["pos"], a["hash"]) for a in r["f"]] for r in P.with_anchors(df, "text", "f").collect()}
    assert {(p + 7, h) for p, h in out[0]} <= set(out[1])
    assert len(out[2]) == 1 and out[3] == [] and 0.3 < len(out[0]) / 196 < 0.7


def test_odd_rows_against_brute_force(spark):
    got = P.compared(spark.createDataFrame(odd_rows(), SCHEMA)).collect()
    for r in got:
        own, after = brute_fingerprint(r["text"]), brute_fingerprint(r["edited"])
        assert [(a["pos"], a["hash"]) for a in r["anchors"]] == own[0] and [(a["pos"], a["hash"]) for a in r["anchors_chars"]] == own[1]
        assert abs(r["near_edited"] - brute_likeness(own, after)) < 1e-12


def test_one_id_for_many_rows_and_ids_of_text(spark, monkeypatch):
    """Rows without an id, or with one id, are dealt over many buckets; ids may be strings."""
    monkeypatch.setattr(P, "BUCKET_ROWS", 4)
    rows = [(None, f"text {i} of a row") for i in range(120)] + [(f"id{i:03}", f"another {i}") for i in range(60)] + [("same", f"shared {i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    placed = P._bucketed(df, "doc_id", "text").filter("ghost = 0").groupBy("b").count().collect()
    assert len(placed) > 20 and max(r["count"] for r in placed) < 60
    got = P.compared(df).collect()
    key = lambda r: (r[0] is not None, r[0] or "", hashed(r[1].encode()))
    ordered = sorted(rows, key=key)
    following = {t: ordered[(i + 1) % len(ordered)][1] for i, (_, t) in enumerate(ordered)}
    assert len(got) == len(rows)
    assert all(r["edited"] == r["text"][: len(r["text"]) - len(r["text"]) // 2] + following[r["text"]][: len(r["text"]) // 2] for r in got)


def test_empty_and_single(spark):
    df = spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")
    assert P.compared(df).first()["edited"] == "abcabc"
    assert P.compared(df.limit(0)).count() == 0


def test_few_words_and_texts_without_spaces_keep_anchors(spark):
    """Halves of few words, and runs without spaces, share anchors with their edited text; 9 long words are still short."""
    japanese = "".join(chr(0x4E00 + (i * 7919) % 5000) for i in range(400))
    data = ";".join(str(i * i) for i in range(300))
    texts = ["three little words", "one text of seven quite different words", " ".join("".join(chr(97 + (i * i + j * j * j + i * j) % 26) for j in range(32)) for i in range(9)), japanese, data, "abcdefghijklmnop😀😁😂"]
    rows = [(2 * i, t) for i, t in enumerate(texts)] + [(2 * i + 1, "QZ" * 2000) for i in range(len(texts))]
    got = {r["id"]: r for r in P.compared(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[2 * i]["near_edited"] > 0.15 and got[2 * i]["aligned_edited"] > 0.15 for i in range(len(texts)))
    assert all(got[2 * i]["near_next"] == 0 for i in range(len(texts)))
    assert len(got[6]["anchors"]) > 100 and len(got[8]["anchors"]) > 100 and not got[8]["anchors_chars"]
