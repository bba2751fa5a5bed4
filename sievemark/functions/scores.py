"""Scores, hashes and text normalization as column expressions."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# What reviewers may write as their verdict.
ACCEPTED = ["1", "accept", "accepted", "positive", "true", "tp", "yes"]
REJECTED = ["0", "false", "fp", "negative", "no", "reject", "rejected"]


def wilson_lower_bound(good: Column, n: Column, level: float) -> Column:
    """Lower end of the Wilson interval; the plain share at level 0, null without samples."""
    p = good / n
    if level == 0:
        return F.when(n > 0, p)
    z = NormalDist().inv_cdf(0.5 + level / 2)  # Spark has no inverse normal; the level is a constant
    denominator = F.lit(1.0) + F.lit(z * z) / n
    centre = p + F.lit(z * z) / (F.lit(2.0) * n)
    margin = F.lit(z) * F.sqrt(p * (F.lit(1.0) - p) / n + F.lit(z * z) / (F.lit(4.0) * n * n))
    return F.when(n > 0, (centre - margin) / denominator)


def confidence_entropy(p: Column) -> Column:
    """Entropy of a yes/no outcome in bits; 0 outside (0, 1)."""
    q = F.lit(1.0) - p
    return F.when((p <= 0) | (p >= 1), F.lit(0.0)).otherwise(-(p * F.ln(p) + q * F.ln(q)) / F.ln(F.lit(2.0)))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def visual_distance(a: Column, b: Column, c: Column, d: Column) -> Column:
    """0 to 1: from the difference hashes a, b and the average hashes c, d."""
    return F.lit(0.7) * hamming(a, b) / F.lit(64.0) + F.lit(0.3) * hamming(c, d) / F.lit(64.0)


def bits_to_long(bits: Column) -> Column:
    """64 booleans, the first the highest bit, as two's complement."""
    return F.aggregate(bits, F.lit(0).cast("long"), lambda acc, b: F.shiftleft(acc, 1).bitwiseOR(b.cast("long")))


def hex_hash(h: Column) -> Column:
    return F.lower(F.lpad(F.hex(h), 16, "0"))


def tenth(v: Column) -> Column:
    """Histogram bin 0 to 9 of a value in [0, 1]; values outside go to the nearest bin."""
    return F.least(F.lit(9), F.greatest(F.lit(0), F.floor(v * 10).cast("int")))


def normalized_image(c: Column) -> Column:
    """Trimmed, with slashes, and folded: besides lower case, sharp s is two letters and a final sigma a sigma."""
    low = F.lower(F.regexp_replace(F.trim(c), r"\\", "/"))
    return F.translate(F.regexp_replace(low, "ß", "ss"), "ς", "σ")


def verdict(c: Column) -> Column:
    """True, false, or null for what is neither."""
    v = F.lower(F.trim(c))
    return F.when(v.isin(ACCEPTED), True).when(v.isin(REJECTED), False)


def unit_float(c: Column) -> Column:
    """The text as a finite number in [0, 1], else null."""
    v = F.expr("0.0D") + F.trim(c).try_cast("double")
    return F.when(~F.isnan(v) & v.between(0.0, 1.0), v)


def routed(conf: Column, auto: Column) -> Column:
    return F.when(conf >= auto, F.lit("auto")).otherwise(F.lit("review"))


def class_name(name: Column, class_id: Column) -> Column:
    return F.coalesce(name, F.concat(F.lit("class_"), class_id.cast("string")))


def stem(path: Column) -> Column:
    """The path without its last suffix."""
    return F.regexp_replace(path, r"\.[^./]*$", "")


def progress_key(class_name: Column, split: Column) -> Column:
    """What a resumed run remembers as done."""
    return F.concat_ws("/", class_name, split)


def sample_name(split: Column, image: Column) -> Column:
    """The file name of a sample picture: split, stem and suffix of the image, joined by underscores."""
    base = F.element_at(F.split(image, "/"), -1)
    return F.concat(F.concat_ws("_", split, stem(base), F.regexp_extract(base, r"\.([^.]*)$", 1)), F.lit(".jpg"))
