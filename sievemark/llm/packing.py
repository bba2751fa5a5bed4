"""Packing into optimal length buckets.

The histogram of lengths over all pieces goes to a dynamic programme that chooses the
bucket boundaries with the least padding in all. Inside each bucket, pieces are dealt
into batches of a fixed token budget: a piece's rank is its rank within a salted part
of its bucket plus the parts before, so no bucket has to pass through one task.

A document longer than ``longest`` is cut into pieces of that length and a remainder;
nothing is dropped. Edge cases: a null or empty text has no tokens and gets no piece;
equal rows are each packed; a document without id is packed like any other. Lengths are
words unless a column says otherwise; ``token_lengths`` gives those of a tokenizer. Extra
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemark.plans.tables import cut

from . import bpe

#: Longest piece, number of buckets, tokens of a batch, and pieces of one salted part.
LONGEST, BUCKETS, BUDGET, PART = 2048, 16, 16_384, 500
#: Copies of one piece that are listed at once.
STEP = 10_000


def words(text: str = "text") -> Column:
    """Length in white-space separated words."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"\S+")), F.lit(0)).cast("long")


def boundaries(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """At most ``buckets`` ascending upper bounds, each a length that occurs, with the least total padding.

    Padding of a bucket is the sum over its pieces of bound minus length. Of equally good choices the fewest buckets win.
    """
    lengths = np.array(sorted(histogram), dtype=np.int64)
    n = len(lengths)
    if not n:
        return []
    count = np.concatenate([[0], np.cumsum([histogram[x] for x in lengths.tolist()])]).astype(np.int64)
    total = np.concatenate([[0], np.cumsum([histogram[x] * x for x in lengths.tolist()])]).astype(np.int64)
    big = np.iinfo(np.int64).max // 4
    best = np.full(n + 1, big, dtype=np.int64)
    best[0] = 0
    chosen = []
    cost_of_all = []
    for _ in range(min(buckets, n)):
        new, frm = np.full(n + 1, big, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
        for j in range(1, n + 1):
            cost = best[:j] + lengths[j - 1] * (count[j] - count[:j]) - (total[j] - total[:j])
            frm[j] = i = int(cost.argmin())
            new[j] = cost[i]
        best = new
        chosen.append(frm)
        cost_of_all.append(int(new[n]))
    k = int(np.argmin(cost_of_all))
    bounds, j = [], n
    while k >= 0 and j:
        bounds.append(int(lengths[j - 1]))
        j = int(chosen[k][j])
        k -= 1
    return bounds[::-1]


def token_lengths(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_tokens): lengths in tokens of a rank file, to be packed by ``pack(..., F.col("n_tokens"))``."""
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return bpe.encode(named, path, pattern).select("doc_id", F.size("ids").cast("long").alias("n_tokens"))


def pack(docs: DataFrame, length: Column | None = None, doc_id: str = "doc_id", longest: int = LONGEST, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """Rows (doc_id, piece, n_tokens, bucket, batch, slot), one for each piece.

    ``bucket`` is the length to which the piece is padded; ``batch`` numbers the
    batches of a bucket from 0, each with at most ``budget`` tokens with padding (or
    one piece); ``slot`` is the place in the batch.
    """
    sized = docs.select(F.col(doc_id).alias("doc_id"), (words() if length is None else length).alias("all")).filter("all > 0")
    pieces = sized.select("doc_id", "all", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("all") - 1) / longest))).alias("piece"))
    # Equal pieces (rows without an id, repeated rows) are counted, not dealt out one by one: they are interchangeable.
    pieces = pieces.select("doc_id", "piece", F.least(F.lit(longest).cast("long"), F.col("all") - F.col("piece") * longest).alias("n_tokens"))
    pieces = cut(pieces.groupBy("doc_id", "piece", "n_tokens").agg(F.count(F.lit(1)).alias("copies")))
    histogram = {r["n_tokens"]: r["n"] for r in pieces.groupBy("n_tokens").agg(F.sum("copies").alias("n")).collect()}  # at most ``longest`` rows
    bounds = boundaries(histogram, buckets) or [longest]
    of = {b: sum(n for x, n in histogram.items() if low < x <= b) for low, b in zip([0, *bounds], bounds)}  # noqa: B905
    choose = F.lit(bounds[-1])
    for b in bounds[-2::-1]:
        choose = F.when(F.col("n_tokens") <= b, b).otherwise(choose)
    parts = F.create_map(*[F.lit(int(x)) for b, n in of.items() for x in (b, max(1, math.ceil(n / PART)))])
    placed = pieces.withColumn("bucket", choose.cast("int"))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "n_tokens"), parts[F.col("bucket")]).cast("int"))
    sizes = placed.groupBy("bucket", "part").agg(F.sum("copies").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    through = F.sum("copies").over(Window.partitionBy("bucket", "part").orderBy("doc_id", "piece", "n_tokens").rowsBetween(Window.unboundedPreceding, 0))
    ranked = placed.withColumn("first", through - F.col("copies"))
    ranked = ranked.join(before.select("bucket", "part", F.coalesce("before", F.lit(0)).alias("before")), ["bucket", "part"])
    # Copies in two steps, so that no array is long.
    many = ranked.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(STEP).cast("long"))))
    each = many.withColumn("copy", F.explode(F.sequence("from", F.least(F.col("from") + STEP, F.col("copies")) - 1)))
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket")))
    at = F.col("before") + F.col("first") + F.col("copy")
    return each.select("doc_id", "piece", "n_tokens", "bucket", F.floor(at / per_batch).alias("batch"), (at % per_batch).alias("slot"))
