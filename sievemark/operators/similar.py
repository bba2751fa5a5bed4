"""Near-duplicate images: Hamming join of 64-bit hashes, components, representatives.

Input rows: (split, path, dhash, ahash, width, height, mean_luma, luma_stddev).
Images are ordered by (split, path).
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.scores import hamming
from sievemark.operators.components import connected_components
from sievemark.plans.ranking import numbered
from sievemark.plans.tables import cut

#: Defaults: largest distances of the two hashes and of aspect ratios, and what counts as flat and as equally bright.
DHASH, AHASH, ASPECT, FLAT, BRIGHT = 6, 10, 0.05, 8.0, 12.0


def bands_for(rows: int, radius: int) -> int:
    """Bands so that a key of ``bands - radius`` of them leaves some 16 rows of ``rows`` random hashes, as far as 300 keys allow."""
    bands = radius + 1
    while bands < 64 and (64 * (bands - radius) // bands) < max(0, rows.bit_length() - 4):
        keys = 1
        for i in range(radius):
            keys = keys * (bands + 1 - i) // (i + 1)
        if keys > 300:
            break
        bands += 1
    return bands


def band_keys(h: Column, radius: int, bands: int) -> Column:
    """Keys of which two hashes within ``radius`` share at least one: with so many bands, ``bands - radius`` are equal."""
    width = [64 * (i + 1) // bands - 64 * i // bands for i in range(bands)]
    start = [64 * i // bands for i in range(bands)]
    masks = [((1 << w) - 1) << s for w, s in zip(width, start, strict=True)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    keys = [F.struct(F.lit(n).alias("band"), h.bitwiseAND(F.lit(signed(sum(masks[i] for i in chosen))).cast("long")).alias("value")) for n, chosen in enumerate(combinations(range(bands), bands - radius))]
    return F.array(*keys)


def matches(a: str, b: str, dhash: int = DHASH, ahash: int = AHASH, aspect: float = ASPECT, flat: float = FLAT, bright: float = BRIGHT) -> Column:
    """Whether the structs ``a`` and ``b`` show the same picture; flat pictures only match flat ones of like brightness."""
    c = lambda s, n: F.col(f"{s}.{n}")
    ra, rb = c(a, "width") / c(a, "height"), c(b, "width") / c(b, "height")
    fa, fb = c(a, "luma_stddev") < flat, c(b, "luma_stddev") < flat
    texture = F.when(fa | fb, fa & fb & (F.abs(c(a, "mean_luma") - c(b, "mean_luma")) <= bright)).otherwise(F.lit(True))
    return (hamming(c(a, "dhash"), c(b, "dhash")) <= dhash) & (hamming(c(a, "ahash"), c(b, "ahash")) <= ahash) & (F.abs(ra - rb) / F.greatest(ra, rb) <= aspect) & texture


FIELDS = ("dhash", "ahash", "width", "height", "mean_luma", "luma_stddev")


def _sides(images: DataFrame, radius: int, bands: int | None) -> DataFrame:
    """Rows (l, r): images within ``radius`` by dhash, the earlier first; each pair once."""
    bands = bands or bands_for(images.count(), radius)
    # Only hashes and names pass through the banding; the other columns join the pairs that are left.
    keyed = images.select("split", "path", "dhash", F.explode(band_keys(F.col("dhash"), radius, bands)).alias("k"))
    side = lambda s: keyed.select(F.col("k.band").alias("band"), F.col("k.value").alias("value"), *[F.col(c).alias(f"{s}_{c}") for c in ("split", "path", "dhash")])
    near = hamming(F.col("l_dhash"), F.col("r_dhash")) <= radius
    first = (F.col("l_split") < F.col("r_split")) | (F.col("l_split") == F.col("r_split")) & (F.col("l_path") < F.col("r_path"))
    found = side("l").join(side("r"), ["band", "value"]).filter(near & first).select("l_split", "l_path", "r_split", "r_path").distinct()
    who = lambda s: images.select(F.col("split").alias(f"{s}_split"), F.col("path").alias(f"{s}_path"), F.struct("split", "path", *FIELDS).alias(s))
    return found.join(who("l"), ["l_split", "l_path"]).join(who("r"), ["r_split", "r_path"]).select("l", "r")


def pairs(images: DataFrame, dhash: int = DHASH, bands: int | None = None, **limits) -> DataFrame:
    """Rows (l_split, l_path, r_split, r_path, l_dhash, distance): all pairs that match, the earlier image left."""
    found = _sides(images, dhash, bands).filter(matches("l", "r", dhash, **limits))
    return found.select(*[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "lr" for c in ("split", "path")], F.col("l.dhash").alias("l_dhash"), hamming(F.col("l.dhash"), F.col("r.dhash")).cast("int").alias("distance"))


def first_edges(found: DataFrame) -> DataFrame:
    """Of the earlier images with one and the same dhash, an image links only with the first that matches."""
    return found.groupBy("r_split", "r_path", "l_dhash").agg(F.min(F.struct("l_split", "l_path")).alias("l")).select("l.l_split", "l.l_path", "r_split", "r_path")


def clusters(images: DataFrame, least: int = 2, full_edges: bool = False, dhash: int = DHASH, bands: int | None = None, **limits) -> DataFrame:
    """Rows (cluster, split, path, size, cross_split, representative, distance): members of groups of ``least`` or more.

    Clusters are numbered from 1 by their smallest path. The representative has the most
    pixels, then the largest path; distance is the member's dhash distance to it.
    """
    found = pairs(images, dhash, bands, **limits)
    edges = found if full_edges else first_edges(found)
    ends = edges.select(F.struct(F.col("l_split").alias("split"), F.col("l_path").alias("path")).alias("src"), F.struct(F.col("r_split").alias("split"), F.col("r_path").alias("path")).alias("dst"))
    c = connected_components(ends).select("node.split", "node.path", F.col("component").alias("root"))
    members = cut(images.join(c, ["split", "path"]))
    best = F.max_by(F.struct("path", "dhash"), F.struct((F.col("width") * F.col("height")).alias("area"), "path"))
    groups = members.groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.count_distinct("split").alias("splits"), F.min("path").alias("first"), best.alias("best")).filter(F.col("size") >= least)
    groups = numbered(groups, ["first", "root"], "cluster")
    out = members.join(groups, "root")
    return out.select("cluster", "split", "path", "size", (F.col("splits") > 1).alias("cross_split"), F.col("best.path").alias("representative"), hamming(F.col("dhash"), F.col("best.dhash")).cast("int").alias("distance"))


def representatives(clustered: DataFrame) -> DataFrame:
    """Rows (cluster, representative, size, splits, cross_split, farthest), one for each group."""
    heads = clustered.groupBy("cluster", "representative", "size", "cross_split")
    return heads.agg(F.sort_array(F.collect_set("split")).alias("s"), F.max("distance").alias("farthest")).select("cluster", "representative", "size", F.array_join("s", ",").alias("splits"), "cross_split", "farthest")


def summary(images: DataFrame, clustered: DataFrame, files: int | None = None, failures: int = 0) -> DataFrame:
    """One row: files, failures, images, clusters, clustered_images, cross_split_clusters, redundant_images, single_images, largest, pairs and cross_split_images."""
    heads = clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.max("cross_split").alias("cross"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    s = heads.agg(
        F.count(F.lit(1)).alias("clusters"), zero(F.sum("size")).alias("clustered_images"), F.count_if("cross").alias("cross_split_clusters"), zero(F.max("size")).alias("largest"),
        zero(F.sum(F.when(F.col("cross"), F.col("size")))).alias("cross_split_images"), zero(F.sum((F.col("size") * (F.col("size") - 1) / 2).cast("long"))).alias("pairs_within"),
    )
    n = images.agg(F.count(F.lit(1)).alias("images"))
    joined = n.join(s, F.lit(True))  # one row each
    return joined.withColumns({"redundant_images": F.col("clustered_images") - F.col("clusters"), "single_images": F.col("images") - F.col("clustered_images"), "files": F.lit(files).cast("long") if files is not None else F.col("images"), "failures": F.lit(failures).cast("long")})


def size_distribution(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).groupBy("size").agg(F.count(F.lit(1)).alias("clusters"))
