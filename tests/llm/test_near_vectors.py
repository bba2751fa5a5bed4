from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemark.llm import near_vectors as V

SCHEMA = "vec_id long, embedding array<float>, label int, key string, copies long"


def brute(rows, cosine=0.95):
    x = [(i, np.array([np.nan if c is None else c for c in v], dtype=np.float64)) if v else (i, None) for i, v in rows]
    ok = [v is not None and np.isfinite(v).all() and (v != 0).any() for _, v in x]
    links, root = Counter(), list(range(len(x)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(x)):
        for j in range(i):
            a, b = x[i][1], x[j][1]
            if ok[i] and ok[j] and len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= cosine - 1e-15:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i in range(len(x)):
        least[find(i)] = min(least.get(find(i), x[i][0]), x[i][0])
    return Counter((x[i][0], links[i], least[find(i)]) for i in range(len(x)))


def made(seed=0):
    """Dense groups, chains and copies around the threshold, and vectors that link with nothing."""
    rng = np.random.default_rng(seed)
    vectors = []
    for size, noise in ((60, 0.18), (40, 0.25), (5, 0.05), (2, 0.3)):
        centre = rng.normal(size=64)
        vectors += [(centre + noise * rng.normal(size=64)).astype(np.float32).tolist() for _ in range(size)]
    walk = rng.normal(size=64)
    for _ in range(15):
        walk = walk + 0.2 * rng.normal(size=64)
        vectors.append(walk.astype(np.float32).tolist())
    vectors += [vectors[0]] * 7 + [rng.normal(size=64).astype(np.float32).tolist() for _ in range(60)]
    vectors += [None, [], [0.0] * 64, [float("nan")] * 64, [float("inf")] + [1.0] * 63, [None] + [1.0] * 63, [1.0, 2.0], [2.0, 4.0], [3.0], [-3.0], [1e-30] * 64, [1e30] * 64]
    return [(int(i), v) for i, v in zip(rng.permutation(len(vectors)), vectors, strict=True)]


@pytest.mark.parametrize("large", [2, 64])
def test_against_all_pairs(spark, monkeypatch, large):
    monkeypatch.setattr(V, "BLOCK_ROWS", 16)
    monkeypatch.setattr(V, "LARGE", large)
    rows = made()
    df = spark.createDataFrame([(i, v, 0, "x", 9) for i, v in rows], SCHEMA)
    got = V.near_duplicates(df).collect()
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert V.near_duplicates(df.limit(0)).count() == 0


def test_busy_bucket_of_vectors_that_do_not_link(spark, monkeypatch):
    """Vectors around one centre that share buckets, most below the threshold, are compared in blocks and all links found."""
    monkeypatch.setattr(V, "_filed", lambda hashed: hashed.select("id", "s", "t", F.lit(0).cast("long").alias("bucket"), F.lit(True).alias("own")))
    monkeypatch.setattr(V, "BLOCK_ROWS", 32)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=64)
    vectors = [(centre + 0.3 * rng.normal(size=64)).astype(np.float32).tolist() for _ in range(300)]
    rows = [(i, v) for i, v in enumerate(vectors + vectors[:20] + [(np.array(v) * 1.01 + 0.01).tolist() for v in vectors[:40]])]
    got = V.near_duplicates(spark.createDataFrame([(i, v, 0, "x", 9) for i, v in rows], SCHEMA)).collect()
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == brute(rows)


def at_cosine(cosine, n=2000, d=64):
    rng = np.random.default_rng(3)
    a = rng.normal(size=(n, d))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (b * a).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    return a, cosine * a + np.sqrt(1 - cosine**2) * b


@pytest.mark.parametrize("axes", V.SHAPES)
def test_recall_at_the_threshold(axes):
    """Pairs with a cosine of just 0.95 meet in some bucket, and their sketches are near."""
    a, b = at_cosine(0.9501)
    x, y = V.buckets(a, axes), V.buckets(b, axes)
    met = (x[:, :, :1] == y).any(axis=(1, 2)) | (y[:, :, :1] == x).any(axis=(1, 2))
    assert met.mean() > 0.999
    bits = lambda p, q: np.bitwise_count((V.sketches(p) ^ V.sketches(q)).view(np.uint64)).sum(axis=1)
    assert bits(a, b).max() <= V.FAR_BITS - 4 and bits(a, a[::-1]).mean() > 60


def test_axes_grow_with_the_classes():
    assert [V.axes_for(n, 64) for n in (1, 50_000, 1_000_000, 50_000_000, 10**9)] == [3, 3, 4, 5, 5]


def test_links_of_a_tight_group_are_counted_without_comparing_it(spark, monkeypatch):
    """All within half the angle of the centre: no blocks at all; a few further out are compared with the rest."""
    seen = []
    blocks = V.in_blocks
    monkeypatch.setattr(V, "in_blocks", lambda hosts, guests, rows, key: seen.append(guests.count()) or blocks(hosts, guests, rows, key))
    rng = np.random.default_rng(9)
    centre = rng.normal(size=64)
    tight = [(centre + 0.1 * rng.normal(size=64)).astype(np.float32).tolist() for _ in range(400)]
    wide = [(centre + 0.24 * rng.normal(size=64)).astype(np.float32).tolist() for _ in range(30)]
    for vectors, outer in ((tight, False), (tight + wide, True)):
        rows = list(enumerate(vectors))
        got = V.near_duplicates(spark.createDataFrame([(i, v, 0, "x", 9) for i, v in rows], SCHEMA)).collect()
        assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == brute(rows)
        assert (seen[-1] > 0) == outer and seen[-1] <= 60


def test_transform_is_a_rotation():
    x = np.random.default_rng(1).normal(size=(16, 5))
    assert np.allclose(V.hadamard(V.hadamard(x.copy())) / 16, x)


@pytest.mark.parametrize("d", [1, 2, 3, 64, 100])
def test_buckets_of_any_width(d):
    x = np.random.default_rng(d).normal(size=(4, d))
    assert V.buckets(x, 3).shape == (4, V.SHAPES[3][0], 1 + V.SHAPES[3][1])
