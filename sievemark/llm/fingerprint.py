"""Document fingerprints from closed syncmers over words, and over characters where words say little.

A text is its sequence of white-space separated words, each hashed to 64 bits; a
character of a script without spaces is a word, and so is each character of a run
longer than ``LONG``. A text of at most ``SHORT`` code points, as every one of fewer
than ten words is, has anchors over its characters besides, and two such texts are
compared by those. Of
all k-word windows those are kept whose smallest s-word part lies at the window's
first or last place. Whether a window is kept depends on its own words only, so an
edit disturbs the anchors next to it and no others. Anchors carry their position,
by which matching anchors of two texts can be aligned. All of it is DataFrame functions.

Edge cases: a null text counts as empty; a text without words has the empty
fingerprint; one with fewer than k words (or characters) has a single anchor of all of them. Equal
fingerprints are alike by 1.0, an empty and a non-empty one by 0.0. Rows that share a
doc_id are ordered by the text's hash; a null doc_id comes first. Ids may be of any type
that has an order. Extra columns are not read. An
empty table gives an empty result; a single document is its own next document.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of a window, and of the parts compared within it.
K, S = 5, 2
#: A longer run without spaces is read by characters, and so is, besides, a text of so few code points.
LONG, SHORT = 32, 300
#: Characters of scripts that set no spaces between words: Thai, Lao, Tibetan, Myanmar, Khmer, kana, Han.
UNSPACED = r"[\u0E00-\u0FFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}]"
#: Documents of one range bucket, and the most buckets.
BUCKET_ROWS, MOST_BUCKETS = 512, 65_536
#: Places looked at for each bucket's bound.
SAMPLED = 8


def words_of(text: Column) -> Column:
    spaced = F.when(text.rlike(UNSPACED), F.regexp_replace(text, f"({UNSPACED})", " $1 ")).otherwise(text)
    return F.filter(F.split(spaced, r"\s+"), lambda w: w != "")


def word_hashes(words: Column) -> Column:
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    pieces = F.flatten(F.transform(words, lambda w: F.when(F.length(w) > LONG, F.transform(F.split(w, ""), lambda c: F.xxhash64(c))).otherwise(F.array(F.xxhash64(w)))))
    return F.when(F.exists(words, lambda w: F.length(w) > LONG), pieces).otherwise(hashed)


def char_hashes(text: Column) -> Column:
    """Of a short text the hashes of its characters, white space as one space; else nothing."""
    chars = F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), "")
    hashed = F.transform(F.filter(chars, lambda c: c != ""), lambda c: F.xxhash64(c))
    return F.when(F.length(text) <= SHORT, hashed).otherwise(F.array().cast("array<bigint>"))


def part_hashes(words: Column, s: int = S) -> Column:
    """Hashes of all s-word parts."""
    n = F.size(words)
    parts = F.transform(F.sequence(F.lit(0), n - s), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(s)]))
    return F.when(n >= s, parts).otherwise(F.array().cast("array<bigint>"))


def anchors_of(words: Column, parts: Column, k: int = K, s: int = S) -> Column:
    """array<struct<pos,hash>> of the closed syncmers, in order of position."""
    n = F.size(words)
    inner = k - s + 1

    def window(i):
        at = [F.get(parts, i + j) for j in range(inner)]
        edge = F.least(at[0], at[-1])
        closed = edge <= F.least(*at) if inner < 3 else edge <= F.least(*at[1:-1])
        return F.when(closed, F.struct((i + 1).alias("pos"), F.xxhash64(*[at[j] for j in range(0, inner)]).alias("hash")))

    many = F.array_compact(F.transform(F.sequence(F.lit(0), n - k), window))
    one = F.array(F.struct(F.lit(1).alias("pos"), F.xxhash64(F.array_join(words.cast("array<string>"), " ")).alias("hash")))
    none = F.array().cast("array<struct<pos:int,hash:bigint>>")
    return F.when(n >= k, many).when(n > 0, one).otherwise(none)


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out`` and ``out``_chars: array<struct<pos,hash>>. In steps, so that no part is computed twice."""
    w, p = f"__w_{out}", f"__p_{out}"
    df = df.withColumn(w, words_of(F.col(text))).withColumn(w, word_hashes(F.col(w)))
    df = df.withColumn(p, part_hashes(F.col(w)))
    df = df.withColumn(out, anchors_of(F.col(w), F.col(p)))
    df = df.withColumn(w, char_hashes(F.col(text))).withColumn(p, part_hashes(F.col(w)))
    return df.withColumn(f"{out}_chars", anchors_of(F.col(w), F.col(p))).drop(w, p)


def shown(anchors: Column, chars: Column) -> Column:
    """``pos:hash`` of each anchor, comma-joined, those over characters with c before; the hash in hexadecimal."""
    each = lambda a: F.concat(a["pos"].cast("string"), F.lit(":"), F.lower(F.hex(a["hash"])))
    return F.array_join(F.concat(F.transform(anchors, each), F.transform(chars, lambda a: F.concat(F.lit("c"), each(a)))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Shared anchors among all anchors of two hash arrays, 0 to 1; 1 if equal, also if both are empty."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - both
    return F.when(every == 0, F.lit(1.0)).otherwise(both / every)


def alike(a: Column, b: Column, a_chars: Column, b_chars: Column) -> Column:
    """``likeness`` by characters if both texts have such anchors, else by words."""
    return F.when((F.size(a_chars) > 0) & (F.size(b_chars) > 0), likeness(a_chars, b_chars)).otherwise(likeness(a, b))


def _bucketed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (b, ghost, id, at, text): ranges of ascending place ``at``; each but the first also ends the one before as a ghost.

    A place is the id and, among rows that share it, the text's hash, so that no id fills
    a bucket by itself. The bounds are places that occur, so a bucket's first rows are
    those with its bound; the overall first rows close the last bucket.
    """
    own_text = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct(F.col(doc_id).isNotNull().alias("named"), F.col(doc_id).alias("id"), F.xxhash64(own_text).alias("h")).alias("at"), F.col(doc_id).alias("id"), own_text.alias("text"))
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low")).first()
    buckets = min(MOST_BUCKETS, max(1, seen["n"] // BUCKET_ROWS))
    bounds: list = []
    if buckets > 1:
        # Places chosen by their hash, about SAMPLED for each bucket; they only say where buckets begin.
        among = max(1, seen["n"] // (buckets * SAMPLED))
        sample = rows.select("at").filter(F.pmod(F.xxhash64("at"), F.lit(among)) == 0).distinct().collect()
        places = sorted((r["at"] for r in sample), key=lambda p: (p["named"], (p["id"],) if p["named"] else (), p["h"]))
        bounds = [p for p in places[::SAMPLED] if p != seen["low"]]
    step = max(1, int(len(bounds) ** 0.5))
    kind = rows.schema["at"].dataType
    schema = T.StructType([T.StructField("low", kind), T.StructField("coarse", T.ArrayType(kind)), T.StructField("fine", T.ArrayType(T.ArrayType(kind)))])
    shown = [p.asDict() for p in bounds]
    text_of = json.dumps({"low": seen["low"] and seen["low"].asDict(), "coarse": shown[::step], "fine": [shown[i : i + step] for i in range(0, len(shown), step)]}, default=str)
    known = docs.sparkSession.range(1).select(F.from_json(F.lit(text_of), schema).alias("k")).select("k.*")  # one literal, no Python rows
    below = lambda places: F.size(F.filter(places, lambda x: x <= F.col("at")))
    d = rows.join(F.broadcast(known), F.lit(True))  # one row, of MOST_BUCKETS places at most
    d = d.withColumn("g", below(F.col("coarse"))).withColumn("group", F.get("fine", F.col("g") - 1))
    d = d.withColumn("k", F.when(F.col("g") == 0, 0).otherwise(below(F.col("group"))))
    d = d.withColumn("b", F.when(F.col("g") == 0, 0).otherwise((F.col("g") - 1) * step + F.col("k")).cast("int"))
    place = lambda b, ghost: F.struct(b.cast("int").alias("b"), F.lit(ghost).alias("ghost"))
    starts = F.get("group", F.col("k") - 1) == F.col("at")  # bucket b begins at bounds[b - 1]
    places = F.array_compact(F.array(place(F.col("b"), 0), F.when(starts, place(F.col("b") - 1, 1)), F.when(F.col("at") == F.col("low"), place(F.lit(len(bounds)), 1))))
    return d.withColumn("place", F.explode(places)).select("place.b", "place.ghost", "id", "at", "text")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, text, edited, anchors, edited_anchors, next_hashes) for each document, and those over characters.

    The edited text is the text with its last floor(n/2) code points replaced by as
    many of the next document's first (all, if it has fewer).
    """
    order = Window.partitionBy("b").orderBy("ghost", "at", "text")
    d = _bucketed(docs, doc_id, text)
    d = d.withColumn("next", F.lead("text").over(order))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next", F.lit(1), half))
    d = with_anchors(d.withColumn("edited", edited).drop("next"), "text", "anchors")
    d = d.withColumns({"next_hashes": F.lead(F.col("anchors.hash")).over(order), "next_hashes_chars": F.lead(F.col("anchors_chars.hash")).over(order)}).filter("ghost = 0")
    return with_anchors(d, "edited", "edited_anchors")


def compared(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``fingerprints`` with near_edited, near_next, and aligned_edited: the share of anchors kept at their own place."""
    d = fingerprints(docs, doc_id, text)
    placed = lambda c: F.transform(F.col(c), lambda a: F.xxhash64(a["pos"], a["hash"]))
    return d.withColumns({
        "near_edited": alike(*[F.col(f"{c}.hash") for c in ("anchors", "edited_anchors", "anchors_chars", "edited_anchors_chars")]),
        "near_next": alike(F.col("anchors.hash"), F.col("next_hashes"), F.col("anchors_chars.hash"), F.col("next_hashes_chars")),
        "aligned_edited": alike(*[placed(c) for c in ("anchors", "edited_anchors", "anchors_chars", "edited_anchors_chars")]),
    })
