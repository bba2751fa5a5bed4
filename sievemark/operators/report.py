"""Summaries of a finished run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.scores import tenth


def mode_counts(candidates: DataFrame) -> DataFrame:
    """Per class: auto and review candidates."""
    return candidates.groupBy("class_id").agg(F.count_if(F.col("mode") == "auto").alias("auto"), F.count_if(F.col("mode") == "review").alias("review"))


def histogram(df: DataFrame, series: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Rows (series, bin, n), ten bins for each series even if empty; a series is (condition, value)."""
    entries = F.array_compact(F.array(*[F.when(cond & v.isNotNull(), F.struct(F.lit(s).alias("series"), tenth(v).alias("bin"))) for s, (cond, v) in series.items()]))
    counted = df.select(F.explode(entries).alias("e")).groupBy("e.series", "e.bin").agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(s) for s in series])).alias("series")).select("series", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("bin"))
    return frame.join(counted, ["series", "bin"], "left").fillna(0, ["n"])
