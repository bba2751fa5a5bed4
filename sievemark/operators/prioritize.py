"""Which images should people look at first, within a budget?

Input: candidates (split, image, class_name, conf) and fingerprints (split, image,
dhash, ahash). Images without fingerprint are failures and do not count.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.functions.scores import confidence_entropy, visual_distance
from sievemark.plans.tables import cut

WEIGHTS = (0.45, 0.20, 0.35)
BUDGET = 200
#: Images that the driver looks at in one pass over the pool.
AHEAD = 1024


def class_rarity(candidates: DataFrame) -> DataFrame:
    """Rows (class_name, n, rarity): the root of the smallest class's count over the class's."""
    n = candidates.groupBy("class_name").agg(F.count(F.lit(1)).alias("n"))
    return n.join(n.agg(F.min("n").alias("least")), F.lit(True)).select("class_name", "n", F.sqrt(F.col("least") / F.col("n")).alias("rarity"))


def items(candidates: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """A row for each readable image: uncertainty, rarity, candidate_count, classes, min_conf, max_conf, hashes."""
    valid = candidates.join(fingerprints, ["split", "image"])
    rare = class_rarity(valid).select("class_name", "rarity")
    per_class = valid.groupBy("split", "image", "class_name").agg(
        F.max(confidence_entropy(F.col("conf"))).alias("uncertainty"), F.count(F.lit(1)).alias("n"), F.min("conf").alias("low"), F.max("conf").alias("high"), F.first("dhash").alias("dhash"), F.first("ahash").alias("ahash"),
    )
    joined = per_class.join(rare, "class_name")
    return joined.groupBy("split", "image").agg(
        F.max("uncertainty").alias("uncertainty"), F.max("rarity").alias("rarity"), F.sum("n").alias("candidate_count"), F.sort_array(F.collect_list("class_name")).alias("classes"),
        F.min("low").alias("min_conf"), F.max("high").alias("max_conf"), F.first("dhash").alias("dhash"), F.first("ahash").alias("ahash"),
    )


def scored(pool: DataFrame, chosen: list, weights: tuple[float, float, float]) -> DataFrame:
    """``pool`` without the ``chosen`` rows, with rarity_score, diversity_score and score as they stand after these choices."""
    spark = pool.sparkSession
    counts = Counter(c for r in chosen for c in r["classes"])
    kinds = {f.name: f.dataType for f in pool.schema.fields}
    state = T.StructType([
        T.StructField("taken", T.ArrayType(T.StructType([T.StructField(c, kinds[c]) for c in ("split", "image")]))),
        T.StructField("hashes", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("dhash", "ahash")]))),
        T.StructField("counts", T.MapType(T.StringType(), T.LongType())),
    ])
    known = spark.createDataFrame([([(r["split"], r["image"]) for r in chosen], [(r["dhash"], r["ahash"]) for r in chosen], dict(counts))], state)
    d = pool.join(F.broadcast(known), F.lit(True))  # one row, of a choice's length at most
    d = d.filter(~F.array_contains("taken", F.struct("split", "image")))
    fewest = F.array_min(F.transform("classes", lambda c: F.coalesce(F.element_at("counts", c), F.lit(0))))
    nearest = F.least(F.lit(1.0), F.coalesce(F.array_min(F.transform("hashes", lambda h: visual_distance(F.col("dhash"), h["dhash"], F.col("ahash"), h["ahash"]))), F.lit(1.0)))
    d = d.withColumns({"rarity_score": F.col("rarity") / F.sqrt(F.lit(1) + fewest), "diversity_score": nearest})
    score = F.lit(weights[0]) * F.col("uncertainty") + F.lit(weights[1]) * F.col("rarity_score") + F.lit(weights[2]) * F.col("diversity_score")
    return d.withColumn("score", score).drop("taken", "hashes", "counts")


def best_rows(d: DataFrame, most: int) -> list:
    """The ``most`` rows by falling score, then split and image, from few rows of each partition."""
    n = d.count()
    if n > 4 * most:
        least = d.agg(F.percentile_approx("score", max(0.0, 1 - 2 * most / n), 100_000).alias("x")).first()["x"]
        above = d.filter(F.col("score") >= least)
        if above.count() >= most:  # the percentile is not exact
            d = above
    return d.orderBy(F.desc("score"), "split", "image").limit(most).collect()


class Ahead:
    """Rows of the pool with their scores as choices are made, in array operations."""

    def __init__(self, rows: list, chosen: list, weights: tuple[float, float, float]):
        self.rows, self.weights = rows, weights
        self.uncertainty = np.array([r["uncertainty"] for r in rows])
        self.rarity = np.array([r["rarity"] for r in rows])
        self.dhash, self.ahash = (np.array([r[c] for r in rows], dtype=np.int64).view(np.uint64) for c in ("dhash", "ahash"))
        names = {c: i for i, c in enumerate(sorted({c for r in [*rows, *chosen] for c in r["classes"]}))}
        self.names, self.has = names, np.zeros((len(rows), len(names)), dtype=bool)
        for i, r in enumerate(rows):
            self.has[i, [names[c] for c in r["classes"]]] = True
        self.counts, self.nearest, self.free = np.zeros(len(names), dtype=np.int64), np.ones(len(rows)), np.ones(len(rows), dtype=bool)
        for r in chosen:
            self.choose(r)

    def choose(self, row) -> None:
        self.counts[[self.names[c] for c in row["classes"]]] += 1
        d, a = (np.array([row[c]], dtype=np.int64).view(np.uint64) for c in ("dhash", "ahash"))
        self.nearest = np.minimum(self.nearest, 0.7 * np.bitwise_count(self.dhash ^ d) / 64.0 + 0.3 * np.bitwise_count(self.ahash ^ a) / 64.0)

    def best(self) -> tuple[int, float, float, float]:
        """Place, score, rarity and diversity of the first of the best free rows by (split, image)."""
        dynamic = self.rarity / np.sqrt(1 + np.where(self.has, self.counts, np.iinfo(np.int64).max).min(axis=1))
        score = self.weights[0] * self.uncertainty + self.weights[1] * dynamic + self.weights[2] * self.nearest
        most = score[self.free].max(initial=-np.inf)
        i = min((i for i in np.flatnonzero(self.free & (score == most)).tolist()), key=lambda i: (self.rows[i]["split"], self.rows[i]["image"]), default=-1)
        return i, float(score[i]), float(dynamic[i]), float(self.nearest[i])


def greedy(pool: DataFrame, budget: int, weights: tuple[float, float, float]) -> list[tuple]:
    """(rank, score, rarity, diversity, split, image) of each choice.

    A choice can only lower the scores of others. So as long as the best of some rows beats
    what all others had when these rows were fetched, it is the best of all; else the next
    rows are fetched, with the scores that the choices have left.
    """
    chosen, out = [], []
    while len(out) < budget:
        rows = best_rows(scored(pool, chosen, weights), AHEAD + 1)
        if not rows:
            break
        bound = rows[AHEAD]["score"] if len(rows) > AHEAD else -math.inf
        ahead = Ahead(rows[:AHEAD], chosen, weights)
        for fetched in range(budget - len(out)):
            i, score, rarity, diversity = ahead.best()
            # The first choice after a fetch is the best of all by that fetch's own order.
            if i < 0 or fetched and score <= bound + 1e-12:
                break
            row = rows[i]
            ahead.free[i] = False
            ahead.choose(row)
            chosen.append(row)
            out.append((len(out) + 1, score, rarity, diversity, row["split"], row["image"]))
    return out


def queue(pool: DataFrame, budget: int = BUDGET, weights: tuple[float, float, float] = WEIGHTS) -> DataFrame:
    """Rows (priority_rank, priority_score, rarity_score, diversity_score, split, image): the greedy choice of ``budget`` images."""
    if budget < 1 or any(w < 0 for w in weights) or not math.isclose(sum(weights), 1.0, abs_tol=1e-9):
        raise ValueError("budget must be positive, and weights must not be negative and sum to 1")
    rows = cut(pool.select("split", "image", "uncertainty", "rarity", "classes", "dhash", "ahash"))
    schema = T.StructType([T.StructField("priority_rank", T.IntegerType()), *[T.StructField(c, T.DoubleType()) for c in ("priority_score", "rarity_score", "diversity_score")], *[T.StructField(c, pool.schema[c].dataType) for c in ("split", "image")]])
    return pool.sparkSession.createDataFrame(greedy(rows, budget, weights), schema)


def queue_candidates(chosen: DataFrame, candidates: DataFrame) -> DataFrame:
    """The original candidates of the chosen images, with their rank."""
    return candidates.join(F.broadcast(chosen.select("split", "image", "priority_rank")), ["split", "image"])  # at most ``budget`` rows


def pool_table(pool: DataFrame, chosen: DataFrame) -> DataFrame:
    """All images with selected and, where selected, their rank and scores."""
    joined = pool.join(F.broadcast(chosen), ["split", "image"], "left")
    return joined.withColumn("selected", F.col("priority_rank").isNotNull())
