"""Does a second model agree, one to one?

Both inputs are rows (split, image, class_id, idx, mode, conf, cx, cy, w, h). One equi
join on (split, image, class) carries the overlap as its residual condition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.functions.boxes import box, overlap

KEY = ["split", "image", "class_id"]
OVERLAP, CONFIDENCE = 0.50, 0.50


def edges(primary: DataFrame, verifier: DataFrame, least_overlap: float = OVERLAP, least_conf: float = CONFIDENCE) -> DataFrame:
    """Rows (split, image, class_id, p_idx, v_idx, p_conf, v_conf, iou): auto primaries and the verifiers that overlap them."""
    p = primary.filter("mode = 'auto'").select(*KEY, F.col("idx").alias("p_idx"), F.col("conf").alias("p_conf"), *[F.col(c).alias(f"{c}_p") for c in ("cx", "cy", "w", "h")])
    v = verifier.filter(F.col("conf") >= least_conf).select(*KEY, F.col("idx").alias("v_idx"), F.col("conf").alias("v_conf"), *[F.col(c).alias(f"{c}_v") for c in ("cx", "cy", "w", "h")])
    joined = p.join(v, KEY).withColumn("iou", overlap(box(suffix="_p"), box(suffix="_v"), "sides"))
    return joined.filter(F.col("iou") >= least_overlap).select(*KEY, "p_idx", "v_idx", "p_conf", "v_conf", "iou")


def assignment(found: DataFrame) -> DataFrame:
    """One-to-one matches, greedily by falling overlap, then falling smaller confidence, then indices.

    Overlapping boxes of one image and class are few; one fold goes through their edges.
    """
    edge = F.struct((-F.col("iou")).alias("a"), (-F.least("p_conf", "v_conf")).alias("b"), "p_idx", "v_idx", "v_conf", "iou")
    grouped = found.groupBy(*KEY).agg(F.array_sort(F.collect_list(edge)).alias("es"))
    taken = F.aggregate(
        "es", F.slice("es", 1, 0),
        lambda acc, x: F.when(F.exists(acc, lambda y: (y["p_idx"] == x["p_idx"]) | (y["v_idx"] == x["v_idx"])), acc).otherwise(F.array_append(acc, x)),
    )
    return grouped.select(*KEY, F.explode(taken).alias("m")).select(*KEY, F.col("m.p_idx").alias("idx"), "m.v_idx", F.col("m.v_conf").alias("verifier_conf"), F.col("m.iou").alias("agreement_iou"))


def decisions(primary: DataFrame, verifier: DataFrame, least_overlap: float = OVERLAP, least_conf: float = CONFIDENCE) -> DataFrame:
    """``primary`` with verifier_conf, agreement_iou, consensus_score and consensus_decision; disagreeing auto rows become review."""
    matches = assignment(edges(primary, verifier, least_overlap, least_conf)).drop("v_idx")
    joined = primary.join(matches, [*KEY, "idx"], "left")
    decision = F.when(F.col("mode") == "review", "primary_review").when(F.col("verifier_conf").isNotNull(), "agreed_auto").otherwise("downgraded_to_review")
    joined = joined.withColumn("consensus_score", F.sqrt(F.col("conf") * F.col("verifier_conf"))).withColumn("consensus_decision", decision)
    return joined.withColumn("mode", F.when(F.col("consensus_decision") == "downgraded_to_review", "review").otherwise(F.col("mode")))


def totals(decided: DataFrame) -> DataFrame:
    """Counters per class and, with class_id null, over all; agreement_rate is 0 without auto rows."""
    count = lambda d: F.count_if(F.col("consensus_decision") == d)
    t = decided.rollup("class_id").agg(F.count(F.lit(1)).alias("primary_candidates"), count("agreed_auto").alias("agreed_auto"), count("downgraded_to_review").alias("downgraded_to_review"), count("primary_review").alias("primary_review"))
    t = t.withColumn("primary_auto", F.col("agreed_auto") + F.col("downgraded_to_review"))
    return t.withColumn("agreement_rate", F.when(F.col("primary_auto") > 0, F.col("agreed_auto") / F.col("primary_auto")).otherwise(F.lit(0.0)))
