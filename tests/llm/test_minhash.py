import random
from collections import Counter

import numpy as np
import pytest

from sievemark.llm import minhash as M

from .texts import SCHEMA, odd_rows, prose

PLAIN = ["doc_id", "n_shingles", "component_id"]
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = (text or "").translate(UPPER).encode().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def brute(rows, width):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [(d, shingles(t, width)) for d, t in rows]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (d, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b:
                both = len(a & b)
                if 100 * both >= 80 * (len(a) + len(b) - both):
                    root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, len(s), least.get(find(i))) for i, (d, s) in enumerate(sets))


def near_rows(seed=2):
    """Chains, stars and pairs just around the threshold, beside unrelated texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(3, 150))]
        for _ in range(rng.randrange(1, 9)):
            rows.append(" ".join(base))
            if rng.random() < 0.5:
                base = list(base)
            for _ in range(rng.randrange(0, 3)):
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
    hub = [rng.choice(vocabulary) for _ in range(120)]
    for _ in range(60):
        own = list(hub)
        for _ in range(rng.randrange(0, 8)):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        rows.append(" ".join(own))
    rows += [prose(rng, rng.randrange(1, 60)) for _ in range(20)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("width", [2, 5])
def test_groups_against_all_pairs(spark, width):
    rows = near_rows()
    got = M.components(spark.createDataFrame(rows, "doc_id long, text string"), width).select(*PLAIN).collect()
    assert Counter(map(tuple, got)) == brute(rows, width)
    assert len({r["component_id"] for r in got}) < len(rows) - 40


def test_large_components_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "LARGE", 4)
    monkeypatch.setattr(M, "BLOCK_ROWS", 3)
    rows = near_rows(9)
    assert Counter(map(tuple, M.components(spark.createDataFrame(rows, "doc_id long, text string"), 2).select(*PLAIN).collect())) == brute(rows, 2)


def test_odd_rows(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    assert Counter(map(tuple, M.components(df, 2).select(*PLAIN).collect())) == brute([r[:2] for r in odd_rows()], 2)
    assert M.components(df.limit(0), 2).count() == 0
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in M.near_duplicates(df, 2).collect())


def test_one_row_of_each_group_stays(spark):
    """Rows that share an id and not a text both stay; copies with and without ids, and equal rows, leave one; clashing columns pass."""
    a, b, c = "one two three four five six", "seven eight nine ten eleven twelve", "alpha beta gamma delta epsilon"
    rows = [(1, a, "x"), (1, b, "y"), (2, a.upper(), "z"), (3, c, "q"), (3, c, "p"), (None, b, "n"), (None, "", "e"), (None, "", "e"), (5, None, "e"), (None, "free text without any id here", "n"), (None, "free text without any id here", "m")]
    for extra in ("row", "id", "g_id", "text_hash", "key"):
        df = spark.createDataFrame(rows, f"doc_id long, text string, {extra} string")
        got = M.deduplicated(df)
        assert got.columns == df.columns
        assert Counter(map(tuple, got.collect())) == Counter([(1, a, "x"), (1, b, "y"), (3, c, "p"), (None, "", "e"), (None, "", "e"), (5, None, "e"), (None, "free text without any id here", "m")])
        if extra == "row":
            assert M.deduplicated(df.limit(0)).count() == 0


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(0)
    items = rng.integers(0, 2**63, size=900, dtype=np.uint64)
    sets = [np.unique(items[:n]) for n in (1, 2, 60, 500)] + [np.unique(items[100:600])]
    s = M.sketches(sets, 320)
    assert not (s == np.uint64(0xFFFFFFFFFFFFFFFF)).any()
    assert abs((s[3] == s[4]).mean() - 400 / 600) < 0.1
    assert (M.sketches([sets[2]], 320)[0] == s[2]).all()


def test_small_tables_of_a_run_are_few_files(spark, tmp_path, monkeypatch):
    """Where Spark does not merge small partitions, intermediate tables do not become a file for each of them."""
    s = spark.newSession()
    s.conf.set("spark.sql.shuffle.partitions", "64")
    s.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr("sievemark.plans.tables.shared_dir", lambda _: f"file://{tmp_path}")
    rows = near_rows(5)
    got = M.components(s.createDataFrame(rows, "doc_id long, text string"), 2).select(*PLAIN).collect()
    assert Counter(map(tuple, got)) == brute(rows, 2)
    tables = [len(list(t.glob("part-*"))) for t in tmp_path.glob("cut-*")]
    assert len(tables) > 9 and sum(n > 2 * s.sparkContext.defaultParallelism for n in tables) <= 4, tables
