"""Is a label data set well formed and free of leaks between splits?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.boxes import crosses_edge

# Kinds of findings that make a data set unusable.
CRITICAL = ["orphan_label", "malformed_line", "non_numeric", "non_finite", "invalid_class_id", "invalid_box", "corrupt_image"]


def checked_lines(lines: DataFrame, classes: int) -> DataFrame:
    """Rows (split, file, line_no, value) with normalized, repeated, problem and crossing.

    ``problem`` is the first fault of a line, null if it is a valid object; a blank line
    is dropped; ``repeated`` says that an earlier line of the file has the same words.
    """
    words = F.filter(F.split("value", r"\s+"), lambda w: w != "")
    parsed = lines.withColumn("__w", words).filter(F.size("__w") > 0).withColumn("normalized", F.array_join("__w", " "))
    names = [f"__v{i}" for i in range(5)]
    numbers = parsed.withColumns({n: F.get("__w", i).try_cast("double") for i, n in enumerate(names)})
    v = [F.col(n) for n in names]
    cx, cy, w, h = v[1:]
    missing, infinite = F.lit(False), F.lit(False)
    for x in v:
        missing = missing | x.isNull()
        infinite = infinite | F.isnan(x) | (F.abs(x) == float("inf"))
    bad_box = (w <= 0) | (h <= 0) | (w > 1) | (h > 1) | ~cx.between(0.0, 1.0) | ~cy.between(0.0, 1.0)
    problem = (
        F.when(F.size("__w") != 5, "malformed_line").when(missing, "non_numeric").when(infinite, "non_finite")
        .when((v[0] != F.floor(v[0])) | (v[0] < 0) | (v[0] >= classes), "invalid_class_id").when(bad_box, "invalid_box")
    )
    first = numbers.groupBy("split", "file", "normalized").agg(F.min("line_no").alias("__first"))
    out = numbers.withColumn("problem", problem).withColumn("class_id", F.when(F.col("problem").isNull(), v[0].cast("int")))
    out = out.withColumn("crossing", F.when(F.col("problem").isNull(), crosses_edge((cx, cy, w, h))).otherwise(F.lit(False)))
    return out.join(first, ["split", "file", "normalized"]).withColumn("repeated", F.col("line_no") > F.col("__first")).drop("__w", *names, "__first")


def line_findings(checked: DataFrame) -> DataFrame:
    """Rows (split, path, line, kind, detail): a line may have several."""
    kinds: Column = F.array_compact(F.array(F.when(F.col("repeated"), "duplicate_label_line"), F.col("problem"), F.when(F.col("crossing"), "box_crosses_image_edge")))
    return checked.select("split", F.col("file").alias("path"), F.col("line_no").alias("line"), F.explode(kinds).alias("kind"), F.substring("normalized", 1, 160).alias("detail"))


def unmatched(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (split, stem, kind): images without a label file, and label files without an image (orphan_label)."""
    i, j = images.select("split", "stem").distinct(), labels.select("split", "stem").distinct()
    missing = i.join(j, ["split", "stem"], "left_anti").withColumn("kind", F.lit("image_without_label"))
    return missing.union(j.join(i, ["split", "stem"], "left_anti").withColumn("kind", F.lit("orphan_label")))


def duplicates(hashed: DataFrame) -> DataFrame:
    """Rows (hash, n, splits, cross_split) for hashes of two files or more. Input: (hash, split)."""
    per_split = hashed.groupBy("hash", "split").agg(F.count(F.lit(1)).alias("n"))
    g = per_split.groupBy("hash").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("splits"))
    return g.filter("n > 1").withColumn("cross_split", F.col("splits") > 1)


def split_statistics(images: DataFrame, labels: DataFrame, checked: DataFrame) -> DataFrame:
    """Per split: images, labels, objects, images_without_label, orphan_labels, empty_labels, bad_label_lines.

    images (split, stem), labels (split, stem, size). Only label files with an image are read, once for each such image.
    """
    read = checked.join(images.select("split", F.col("stem").alias("file")), ["split", "file"])
    lines = read.groupBy("split").agg(F.count_if(F.col("problem").isNull()).alias("objects"), F.count_if(F.col("problem").isNotNull()).alias("bad_label_lines"))
    apart = unmatched(images, labels).groupBy("split").agg(F.count_if(F.col("kind") == "image_without_label").alias("images_without_label"), F.count_if(F.col("kind") == "orphan_label").alias("orphan_labels"))
    n_images = images.groupBy("split").agg(F.count(F.lit(1)).alias("images"))
    empty = images.join(labels, ["split", "stem"]).groupBy("split").agg(F.count_if(F.col("size") == 0).alias("empty_labels"))
    n_labels = labels.groupBy("split").agg(F.count(F.lit(1)).alias("labels"))
    out = n_images.join(n_labels, "split", "full")
    for part in (lines, apart, empty):
        out = out.join(part, "split", "left")
    return out.fillna(0)


def class_objects(checked: DataFrame, classes: DataFrame) -> DataFrame:
    """Objects of each class in ``classes`` (class_id, class_name), 0 where there are none."""
    # class_id is null for lines with a fault, and no class joins that.
    n = checked.groupBy("class_id").agg(F.count(F.lit(1)).alias("objects"))
    return classes.join(n, "class_id", "left").fillna(0, ["objects"])


def issue_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).withColumn("critical", F.col("kind").isin(CRITICAL))


def details(findings: DataFrame, most: int = 5000) -> DataFrame:
    """The first ``most`` findings in a fixed order; counts are not affected."""
    return findings.orderBy("split", "path", F.col("line").asc_nulls_first(), "kind", "detail").limit(most)


def status(findings: DataFrame) -> DataFrame:
    """One row: critical, warnings, and status fail, warn or pass."""
    s = issue_counts(findings).agg(F.coalesce(F.sum(F.when(F.col("critical"), F.col("n"))), F.lit(0)).alias("critical"), F.coalesce(F.sum(F.when(~F.col("critical"), F.col("n"))), F.lit(0)).alias("warnings"))
    return s.withColumn("status", F.when(F.col("critical") > 0, "fail").when(F.col("warnings") > 0, "warn").otherwise("pass"))
