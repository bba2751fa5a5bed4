"""A dense number in a global order without passing all rows through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.plans.tables import cut


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with ``name``: 1, 2, ... by ``order``. Each sorted partition counts alone; its start is the sum of those before."""
    low = F.monotonically_increasing_id()  # partition number in the upper bits, row of the partition in the lower 33
    placed = cut(df.orderBy(*order).withColumn("__id", low))
    part = F.shiftright("__id", 33)
    counts = {r["p"]: r["n"] for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = {}, 0
    for p in sorted(counts):
        starts[p], total = total, total + counts[p]
    if not starts:
        return placed.withColumn(name, F.lit(0).cast("long")).drop("__id")
    start = F.create_map(*[F.lit(x).cast("long") for kv in starts.items() for x in kv])
    return placed.withColumn(name, start[part] + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("__id")
