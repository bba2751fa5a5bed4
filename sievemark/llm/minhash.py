"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A document is the set of its word shingles. Documents with the same set form one
class. A class's sketch is filled in rounds: in each round every shingle is hashed to
one place and value, and places keep the least (round, value); after as many rounds as
there are places, round ``t + i`` puts every shingle into place ``i``, so all places
fill (Dahlgaard, Knudsen and Thorup, 2017). Classes that share a band of places are
candidates, and links are confirmed on the full sets.

Groups are joined without listing their pairs: in each bucket all members are first
compared with its smallest member. Links found so give components; then, in buckets
whose members lie in different components, every member outside the bucket's largest
component is compared with all members of other components (where they are many, in blocks).
So every candidate pair is confirmed or lies within one component already.

Edge cases: texts without words, null and empty ones have an empty set and link with
nothing; shorter texts than a shingle have one shingle of all their words. Rows without
an id are compared like others, but give a group no name: their component is null where
no member has an id. Equal rows stay equal rows; rows that share an id and not a text
are documents of their own. Extra columns are not read. An empty table gives an empty
result. ``deduplicated`` keeps one row of each group: that of the smallest id (one with
an id, if any has), of these the text with the smallest hash, of rows equal in both the
first by all columns. Rows without words all stay.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.operators.components import connected_components
from sievemark.plans.tables import apart, cut, fitted

from .bpe import blocks
from .common import in_blocks, mix, ship

#: Bands and places of a band: 0.8 alike misses all bands once in 1600 pairs, 0.85 once in 300,000, 0.9 never to speak of.
BANDS, ROWS = 40, 8
#: Least similarity in hundredths, and bytes of text that a worker handles at once.
SIMILAR, BLOCK = 80, 4_000_000
#: Words that a worker remembers.
MOST_WORDS = 250_000
#: Components and buckets with so many classes are compared in blocks of so many rows.
LARGE, BLOCK_ROWS = 64, 256
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


WORDS = Hashes()


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text. Words end at ASCII white space; A-Z is lower-cased."""
    if len(WORDS) > MOST_WORDS:
        WORDS.clear()
    words = [t.encode("utf-8", "replace").translate(LOWER).split() for t in texts]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    flat = np.fromiter(map(WORDS.__getitem__, (w for ws in words for w in ws)), dtype=np.uint64, count=int(sizes.sum()))
    begins = np.cumsum(sizes) - sizes
    whole = np.zeros(len(flat) + 1, dtype=np.uint64)
    if len(flat) >= width:
        rolled = np.zeros(len(flat) - width + 1, dtype=np.uint64)
        for i in range(width):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + flat[i : len(flat) - width + 1 + i]
        whole[: len(rolled)] = mix(rolled)
    out = []
    for begin, n in zip(begins.tolist(), sizes.tolist(), strict=True):
        if n >= width:
            out.append(np.unique(whole[begin : begin + n - width + 1]))
        elif n:
            out.append(np.array([xxhash.xxh3_64_intdigest(b"%d " % n + flat[begin : begin + n].tobytes())], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def sketches(sets: list[np.ndarray], places: int) -> np.ndarray:
    """The filled sketch of each non-empty set: least (round, value) of each place."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full((len(sets), places), empty, dtype=np.uint64)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    items = np.concatenate([np.zeros(0, dtype=np.uint64), *sets])
    for i in range(2 * places):
        if not len(items):
            break
        h = mix(items + np.uint64((i + 1) * 0x9E3779B97F4A7C15 % 2**64))
        at = ((h & np.uint64(0xFFFF)) * np.uint64(places) >> np.uint64(16)).astype(np.int64) if i < places else np.full(len(items), i - places)
        np.minimum.at(out.reshape(-1), of * places + at, (np.uint64(i) << np.uint64(48)) | (h >> np.uint64(16)))
        rows = np.unique(of)
        todo = np.zeros(len(sets), dtype=bool)
        todo[rows[(out[rows] == empty).any(axis=1)]] = True
        keep = todo[of]
        items, of = items[keep], of[keep]
    return out


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(sketch), bands), dtype=np.uint64)
    for j in range(rows):
        keys = mix(keys * np.uint64(31) + sketch[:, j::rows][:, :bands] + np.arange(bands, dtype=np.uint64))
    return keys


def text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def signatures(docs: DataFrame, width: int, doc_id: str = "doc_id", text: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Rows (doc_id, text_hash, n_shingles, key, buckets): key identifies the set (null if empty), buckets are its bands."""
    ship(__name__)
    named = docs.select(F.col(doc_id).alias("doc_id"), text_hash(text).alias("text_hash"), F.col(text).alias("text"))
    schema = T.StructType([*named.schema.fields[:2], T.StructField("n_shingles", T.LongType()), T.StructField("key", T.BinaryType()), T.StructField("buckets", T.ArrayType(T.LongType(), False))])

    def run(batches):
        for batch in batches:
            for b in blocks(batch, "text", BLOCK):
                sets = shingle_sets([t or "" for t in b.column("text").to_pylist()], width)
                full = [s for s in sets if len(s)]
                keys = iter(band_keys(sketches(full, bands * rows), bands, rows).view(np.int64))
                lists = [next(keys) if len(s) else np.zeros(0, dtype=np.int64) for s in sets]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *lists])))],
                    names=schema.fieldNames(),
                )

    return named.mapInArrow(run, schema)


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int, doc_id: str, text: str) -> DataFrame:
    """Rows (id, items) for the classes in ``wanted`` (id, key, rep, text_hash), from their first document's text."""
    ship(__name__)
    d = docs.select(F.col(doc_id).alias("doc_id"), text_hash(text).alias("hash"), F.col(text).alias("text"))
    d = d.join(wanted, (d["hash"] == wanted["text_hash"]) & d["doc_id"].eqNullSafe(wanted["rep"])).select("text", "id", "key")

    def run(batches):
        for batch in batches:
            for b in blocks(batch, "text", BLOCK):
                sets = shingle_sets([t or "" for t in b.column("text").to_pylist()], width)
                own = [(i, s.view(np.int64)) for i, k, s in zip(b.column("id").to_pylist(), b.column("key").to_pylist(), sets, strict=True) if xxhash.xxh3_128_digest(s.tobytes()) == k]
                offsets = np.concatenate([[0], np.cumsum([len(s) for _, s in own])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in own], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *[s for _, s in own]])))], names=["id", "items"])

    # Repeated rows give a class more than once.
    return d.mapInArrow(run, "id bigint, items array<bigint>").groupBy("id").agg(F.first("items").alias("items"))


def _can_link(n: Column, m: Column, similar: int) -> Column:
    """No two sets whose sizes differ more can be similar enough."""
    return F.lit(100) * F.least(n, m) >= F.lit(similar) * F.greatest(n, m)


def _confirmed(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs (a, b) that are similar enough on their full sets."""
    joined = pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("items").alias("y")), "b")
    both = F.size(F.array_intersect("x", "y")).cast("long")
    return joined.withColumn("both", both).filter(F.lit(100) * F.col("both") >= F.lit(similar) * (F.size("x") + F.size("y") - F.col("both"))).select("a", "b")


def _in_blocks(hosts: DataFrame, guests: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """Links (a, b) of guests to hosts of the same ``grp`` in other components; of a block, one to each component.

    Both are rows (grp, component, id). Pairs are not listed: blocks of hosts meet blocks of guests.
    """
    ship(__name__)
    rows = in_blocks(hosts, guests, BLOCK_ROWS, "id").join(sets, "id")

    def check(pdf):
        own, guests = pdf[~pdf["guest"]], pdf[pdf["guest"]]
        found = []
        if len(own):
            flat, sizes = np.concatenate(list(own["items"])), own["items"].map(len).to_numpy()
            of, names = np.repeat(np.arange(len(own)), sizes), own["id"].to_numpy()
            part = pd.factorize(own["component"])[0]
            for key, mine, items in zip(guests["id"], guests["component"], guests["items"], strict=True):
                x = np.sort(items)
                at = np.minimum(np.searchsorted(x, flat), len(x) - 1)
                both = np.bincount(of[x[at] == flat], minlength=len(own))
                hit = np.flatnonzero((100 * both >= similar * (len(x) + sizes - both)) & (own["component"] != mine).to_numpy())
                found += [(key, names[hit[i]]) for i in np.unique(part[hit], return_index=True)[1]]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return rows.groupBy("grp", "block", "chunk").applyInPandas(check, "a bigint, b bigint")


def components(docs: DataFrame, width: int = 5, similar: int = SIMILAR, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, text_hash, n_shingles, component_id, chosen) for each document.

    component_id is the smallest id reachable over links of similar documents; chosen are
    the group's smallest id's rows with the smallest text hash, and rows without words.
    """
    signed = cut(signatures(docs, width, doc_id, text))
    leader = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    classes = signed.filter("key is not null").groupBy("key").agg(F.min(leader).alias("leader"), F.first("n_shingles").alias("n"), F.first("buckets").alias("buckets"))
    classes = cut(classes.withColumn("id", F.monotonically_increasing_id()))
    members = classes.select("id", "n", F.explode("buckets").alias("bucket"))
    centres = members.groupBy("bucket", apart("bucket")).agg(F.min(F.struct("id", "n")).alias("c"), F.count(F.lit(1)).alias("size")).filter("size > 1").select("bucket", "c")
    shared = cut(members.join(centres, "bucket"))
    wanted = classes.select("id", "key", F.col("leader.doc_id").alias("rep"), "leader.text_hash").join(shared.select("id").distinct(), "id")
    sets = cut(_sets_of(docs, fitted(cut(wanted)), width, doc_id, text))
    star = shared.filter(F.col("id") != F.col("c.id")).filter(_can_link(F.col("n"), F.col("c.n"), similar)).select(F.col("id").alias("a"), F.col("c.id").alias("b")).distinct()
    links = cut(_confirmed(star, sets, similar))
    first = connected_components(links, "a", "b").withColumnRenamed("node", "id")

    placed = cut(shared.select("bucket", "id", "n").join(first, "id", "left").withColumn("component", F.coalesce("component", "id")))
    counted = cut(placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("size")))
    largest = counted.groupBy("bucket", apart("bucket")).agg(F.max(F.struct("size", "component")).alias("largest"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    outside = cut(placed.join(largest.select("bucket", F.col("largest.component").alias("main")), "bucket").filter("component <> main").drop("main"))
    # Members outside against large components, in blocks of those.
    large = cut(first.groupBy("component").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= LARGE).select("component"))
    near = counted.join(large, "component", "left_semi").select("bucket", F.col("component").alias("grp"))
    hosts = first.join(large, "component", "left_semi").select(F.col("component").alias("grp"), "component", "id")
    guests = cut(outside.join(near, "bucket").filter("component <> grp").select("grp", "component", "id").distinct())
    found = [_in_blocks(hosts, guests, sets, similar)]
    # Against the others: in blocks where a bucket holds many, else pair by pair.
    rest = cut(placed.join(large, "component", "left_anti"))
    busy = cut(rest.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= LARGE).select("bucket"))
    by_bucket = lambda df: df.join(busy, "bucket", "left_semi").select(F.col("bucket").alias("grp"), "component", "id")
    found.append(_in_blocks(by_bucket(rest), by_bucket(outside), sets, similar))
    other = rest.join(busy, "bucket", "left_anti").select("bucket", F.col("id").alias("b"), F.col("n").alias("m"), F.col("component").alias("theirs"))
    across = outside.join(other, "bucket").filter(F.col("component") != F.col("theirs")).filter(_can_link(F.col("n"), F.col("m"), similar))
    across = across.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()
    more = cut(_confirmed(across, sets, similar).union(found[0]).union(found[1]))
    final = connected_components(links.union(more), "a", "b").withColumnRenamed("node", "id")

    # Written, so that both sides of the next joins are plain shuffles and a large component can be split.
    linked = cut(final.join(classes.select("id", "leader"), "id"))
    least = linked.groupBy("component", apart("component")).agg(F.min("leader").alias("leader"))
    named = cut(linked.select("id", "component").join(least, "component").select("id", F.col("leader").alias("group")))
    labels = cut(classes.select("id", "key", "leader").join(named, "id", "left").select("key", F.coalesce("group", "leader").alias("group")))
    result = signed.select("doc_id", "text_hash", "n_shingles", "key").join(labels, "key", "left")
    empty = F.col("key").isNull()
    chosen = empty | F.col("doc_id").eqNullSafe(F.col("group.doc_id")) & (F.col("text_hash") == F.col("group.text_hash"))
    return result.select("doc_id", "text_hash", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("group.doc_id")).alias("component_id"), chosen.alias("chosen"))


def near_duplicates(docs: DataFrame, width: int = 5, similar: int = SIMILAR, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept): kept are the rows of the group's smallest id, or all if none has one."""
    c = components(docs, width, similar, doc_id, text)
    return c.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicated(docs: DataFrame, width: int = 5, similar: int = SIMILAR, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group one row stays, unchanged."""
    c = cut(components(docs, width, similar, doc_id, text))
    who = lambda df: df.select(F.col("doc_id").alias("g_id"), F.col("text_hash").alias("g_hash"))
    # The columns travel in one, so none of their names can clash.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(doc_id).alias("r_id"), text_hash(text).alias("r_hash"))
    same = (F.col("r_hash") == F.col("g_hash")) & F.col("r_id").eqNullSafe(F.col("g_id"))
    stay = rows.join(fitted(cut(who(c.filter("not chosen")).distinct())), same, "left_anti")
    again = cut(who(c.filter("chosen and n_shingles > 0")).groupBy("g_id", "g_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    if not again.isEmpty():
        one = stay.join(again, same, "left_semi").groupBy("r_id", "r_hash").agg(F.min_by("row", F.to_json("row")).alias("row"))
        stay = stay.join(again, same, "left_anti").select("row").union(one.select("row"))
    return stay.select("row.*")
