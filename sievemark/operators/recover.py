"""Which predictions are labels that are missing?

predictions (split, image, class_id, idx, conf, cx, cy, w, h) against labels (split,
image, class_id, cx, cy, w, h). Both meet in one shuffle on (split, image, class_id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemark.functions.boxes import box, of_struct, overlap
from sievemark.functions.scores import routed

KEY = ["split", "image", "class_id"]
#: Default overlaps from which a prediction counts as labelled, or as a repeat of a better one.
EXISTING, REPEATED = 0.50, 0.95


def best_overlap(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """``predictions`` with max_iou: the largest overlap with a label of the same image and class, 0 without one."""
    other = labels.select(*KEY, *[F.col(c).alias(f"{c}_l") for c in ("cx", "cy", "w", "h")])
    joined = predictions.join(other, KEY, "left").withColumn("__iou", overlap(box(), box(suffix="_l")))
    # Grouped by columns that begin with the join key: the join's partitioning serves.
    return joined.groupBy(*predictions.columns).agg(F.coalesce(F.max("__iou"), F.lit(0.0)).alias("max_iou"))


def unlabelled(predictions: DataFrame, labels: DataFrame, existing: float = EXISTING) -> DataFrame:
    """Predictions without a label that overlaps by ``existing`` or more, as an anti join."""
    p, other = predictions.alias("p"), labels.alias("l")
    same = [F.col(f"p.{c}") == F.col(f"l.{c}") for c in KEY]
    condition: Column = overlap(box("p."), box("l.")) >= existing
    for s in same:
        condition = condition & s
    return p.join(other, condition, "left_anti")


def candidates(predictions: DataFrame, labels: DataFrame, thresholds: DataFrame, existing: float = EXISTING) -> DataFrame:
    """Unlabelled predictions with max_iou and mode: auto from the class's auto_thr on, review from review_thr on."""
    found = best_overlap(predictions, labels).filter(F.col("max_iou") < existing)
    routed_by = found.join(F.broadcast(thresholds), "class_id")  # one row for each class
    return routed_by.filter(F.col("conf") >= F.col("review_thr")).withColumn("mode", routed(F.col("conf"), F.col("auto_thr"))).drop("auto_thr", "review_thr")


def distinct_boxes(df: DataFrame, repeated: float = REPEATED) -> DataFrame:
    """Of each image and class, greedily by falling confidence, the boxes that overlap no accepted one by ``repeated``.

    Ties go to the smaller idx. A detector gives a bounded number of boxes for an image
    and class, which one fold goes through.
    """
    rest = [c for c in df.columns if c not in KEY]
    item = F.struct((-F.col("conf")).alias("__order"), F.col("idx").alias("__idx"), *rest)
    grouped = df.groupBy(*KEY).agg(F.array_sort(F.collect_list(item)).alias("items"))
    nothing = F.slice("items", 1, 0)
    kept = F.aggregate(
        "items", nothing,
        lambda acc, x: F.when(F.exists(acc, lambda y: overlap(of_struct(x), of_struct(y)) >= repeated), acc).otherwise(F.array_append(acc, x)),
    )
    return grouped.select(*KEY, F.explode(kept).alias("x")).select(*[F.col(c) if c in KEY else F.col(f"x.{c}") for c in df.columns])


def class_statistics(predictions: DataFrame, labels: DataFrame, thresholds: DataFrame, existing: float = EXISTING, repeated: float = REPEATED) -> DataFrame:
    """Per class: predictions, matched, repeats, auto, review."""
    best = best_overlap(predictions, labels).join(F.broadcast(thresholds), "class_id").filter(F.col("conf") >= F.col("review_thr"))
    best = best.withColumn("mode", routed(F.col("conf"), F.col("auto_thr"))).drop("auto_thr", "review_thr")
    total = best.groupBy("class_id").agg(F.count(F.lit(1)).alias("predictions"), F.count_if(F.col("max_iou") >= existing).alias("matched"))
    kept = distinct_boxes(best.filter(F.col("max_iou") < existing), repeated)
    routes = kept.groupBy("class_id").agg(F.count_if(F.col("mode") == "auto").alias("auto"), F.count_if(F.col("mode") == "review").alias("review"))
    joined = total.join(routes, "class_id", "left").fillna(0, ["auto", "review"])
    return joined.withColumn("repeats", F.col("predictions") - F.col("matched") - F.col("auto") - F.col("review"))


def top_images(df: DataFrame, most: int = 80) -> DataFrame:
    """Of each mode and class, the ``most`` images by highest confidence; ties go to the later image.

    Rows (mode, class_id, split, image, score, n, rank).
    """
    images = df.groupBy("mode", "class_id", "split", "image").agg(F.max("conf").alias("score"), F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("mode", "class_id").orderBy(F.col("score").desc(), F.col("split").desc(), F.col("image").desc())
    return images.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def label_lines(df: DataFrame) -> Column:
    """A box as a label line; coordinates are millionths, so text does not depend on the engine's rounding of text."""
    million = lambda c: F.round(F.col(c) * 1_000_000).cast("long").cast("string")
    return F.concat_ws(" ", F.col("class_id").cast("string"), *[million(c) for c in ("cx", "cy", "w", "h")])


def merged_labels(labels: DataFrame, additions: DataFrame) -> DataFrame:
    """Per label file the distinct lines of both, and how many are new: (split, image, lines, added). Doing it again adds nothing."""
    old = labels.select("split", "image", label_lines(labels).alias("line"), F.lit(1).alias("old"))
    new = additions.select("split", "image", label_lines(additions).alias("line"), F.lit(0).alias("old"))
    lines = old.union(new).groupBy("split", "image", "line").agg(F.max("old").alias("old"))
    return lines.groupBy("split", "image").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.lit(1) - F.col("old")).alias("added"))
