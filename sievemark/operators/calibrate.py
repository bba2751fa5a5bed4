"""Which thresholds does human review support? Input rows: (class_name, conf, accepted)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievemark.functions.scores import wilson_lower_bound

PRECISION, LEVEL, RECALL, SAMPLES = 0.98, 0.95, 0.95, 20


def curve(reviewed: DataFrame, level: float = LEVEL) -> DataFrame:
    """A row for each class and confidence: what a threshold there selects.

    Equal confidences are summed before the running sum, so ties count together and
    the window sees one row for each distinct confidence.
    """
    tied = reviewed.groupBy("class_name", F.col("conf").alias("threshold")).agg(F.count(F.lit(1)).alias("n"), F.count_if("accepted").alias("good"))
    down = Window.partitionBy("class_name").orderBy(F.col("threshold").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("class_name")
    c = tied.select("class_name", "threshold", F.sum("n").over(down).alias("selected"), F.sum("good").over(down).alias("true_positive"), F.sum("good").over(whole).alias("__all"))
    return c.select(
        "class_name", "threshold", "selected", "true_positive", (F.col("selected") - F.col("true_positive")).alias("false_positive"),
        (F.col("true_positive") / F.col("selected")).alias("precision"), wilson_lower_bound(F.col("true_positive"), F.col("selected"), level).alias("precision_lower_bound"),
        F.when(F.col("__all") > 0, F.col("true_positive") / F.col("__all")).alias("recall"),
    )


def policy(reviewed: DataFrame, precision: float = PRECISION, level: float = LEVEL, recall: float = RECALL, samples: int = SAMPLES) -> DataFrame:
    """A row for each class: the lowest threshold that may accept alone, the highest that still finds enough, and the queue between."""
    for name, v, top in (("precision", precision, 1.0), ("recall", recall, 1.0)):
        if not 0 < v <= top:
            raise ValueError(f"{name} must be in (0, 1]: {v}")
    if not 0 <= level < 1 or samples < 1:
        raise ValueError("level must be in [0, 1) and samples at least 1")
    points = curve(reviewed, level)
    point = F.struct("threshold", "precision", "precision_lower_bound", "recall", "selected")
    auto = points.filter((F.col("selected") >= samples) & (F.col("precision_lower_bound") >= precision)).groupBy("class_name").agg(F.min_by(point, "threshold").alias("auto"))
    below = points.join(auto, "class_name", "left").filter((F.col("threshold") <= F.coalesce("auto.threshold", F.lit(1.0))) & (F.col("recall") >= recall))
    review = below.groupBy("class_name").agg(F.max_by(point, "threshold").alias("review"))
    bounds = auto.join(review, "class_name", "full")
    rows = reviewed.join(bounds, "class_name", "left")  # a row for each class, found by AQE to be small
    queued = (F.col("conf") >= F.col("review.threshold")) & (F.col("auto").isNull() | (F.col("conf") < F.col("auto.threshold")))
    counts = rows.groupBy("class_name").agg(
        F.count(F.lit(1)).alias("samples"), F.count_if("accepted").alias("accepted"), F.count_if(queued).alias("review_queue_samples"), F.count_if(queued & F.col("accepted")).alias("__good"),
    )
    r = counts.join(bounds, "class_name", "left")
    status = F.when(F.col("accepted") == 0, "no_positive_samples").when(F.col("auto").isNull(), "auto_target_not_met").when(F.col("review").isNull(), "review_target_not_met").otherwise("calibrated")
    return r.select(
        "class_name", status.alias("status"), "samples", "accepted", (F.col("samples") - F.col("accepted")).alias("rejected"), (F.col("accepted") / F.col("samples")).alias("acceptance_rate"),
        F.col("auto.threshold").alias("auto_threshold"), F.col("auto.precision").alias("auto_precision"), F.col("auto.precision_lower_bound").alias("auto_precision_lower_bound"), F.col("auto.recall").alias("auto_recall"),
        F.coalesce("auto.selected", F.lit(0)).cast("long").alias("auto_samples"), F.col("review.threshold").alias("review_threshold"), F.col("review.recall").alias("captured_positive_recall"), "review_queue_samples",
        F.when(F.col("review_queue_samples") > 0, F.col("__good") / F.col("review_queue_samples")).alias("review_queue_acceptance_rate"),
    )
