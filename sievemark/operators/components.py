"""Connected components of an edge table by alternating star contraction.

Each round rewires every node to the smallest neighbour (Kiveris et al., 2014), so
the number of rounds grows with the logarithm of the longest path; edges that are
stars already need none. The smallest neighbours are found by map-side combined
aggregations whose shuffle is not the joins' (``plans.tables.apart``), so that Spark
can split a hub's rows among tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.plans.tables import apart, cut


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is the upper end of at most one edge, and then of no other edge the lower end."""
    ends = edges.select(F.col("hi").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("lo", F.lit(0), F.lit(1)))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.filter("up > 1 or up = 1 and down = 1").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
    least = both.groupBy("u", apart("u")).agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).filter("hi <> lo").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi", apart("hi")).agg(F.min("lo").alias("m")).select("hi", "m")
    moved = edges.join(least, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.union(least).distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Rows (node, component) for every node of an edge that is not a self loop.

    ``component`` is the smallest node reachable. Edges with a null end and self
    loops are ignored; repeated edges count once; no edges give no rows.
    """
    e = edges.select(F.greatest(src, dst).alias("hi"), F.least(src, dst).alias("lo"))
    e = cut(e.filter(F.col(src).isNotNull() & F.col(dst).isNotNull()).filter("hi <> lo").distinct())
    while not _are_stars(e):
        e = cut(_small_star(cut(_large_star(e))))
    roots = e.select(F.col("lo").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
