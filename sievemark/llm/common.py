"""What several of the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.plans import shipping
from sievemark.plans.tables import apart

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(c, ASCII_UPPER, ASCII_UPPER.lower())


#: Values of an array that ``running`` passes over at once.
RUN = 512


def running(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each number of an array<bigint> what ``add`` makes of 0 and all before it; by blocks, as appending copies an array."""
    zero, none = F.lit(0).cast("bigint"), F.array().cast("array<bigint>")
    state = F.struct(zero.alias("at"), none.alias("out"))
    step = lambda acc, x: F.struct(add(acc["at"], x).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / RUN).cast("int")), lambda b: F.slice(values, b * RUN + 1, F.lit(RUN)))
    inner = F.transform(blocks, lambda v: F.aggregate(v, state, step))
    outer = F.aggregate(F.transform(inner, lambda x: x["at"]), state, step)["out"]
    every = F.flatten(F.zip_with(inner, outer, lambda x, o: F.transform(x["out"], lambda y: add(o, y))))
    return F.when(F.size(values) > 0, every).otherwise(none)


def ship(module: str) -> None:
    """Let executors run ``module``'s functions, and these, even if they cannot import this package."""
    shipping.ship(module, __name__)


def remembered(table: dict, key, make: Callable, most: int):
    """``table[key]``, made if it is missing; a table of ``most`` entries starts anew."""
    if key not in table:
        if len(table) >= most:
            table.clear()
        table[key] = make()
    return table[key]


M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * M1
    h = (h ^ (h >> np.uint64(27))) * M2
    return h ^ (h >> np.uint64(31))


def in_blocks(hosts: DataFrame, guests: DataFrame, rows: int, key: str = "key") -> DataFrame:
    """Rows (grp, component, <key>, block, chunk, guest) in which every guest meets every host of its ``grp``.

    Both are rows (grp, component, <key>). A group's hosts stand in blocks and its guests in
    chunks of about ``rows``, so that one task sees one block and one chunk, however large the group.
    """
    there = hosts.select("grp", F.lit(1).alias("h"), F.lit(0).alias("g")).union(guests.select("grp", F.lit(0), F.lit(1)))
    of = lambda c: F.ceil(F.sum(c) / rows).cast("int")
    plan = there.groupBy("grp", apart("grp")).agg(of("h").alias("blocks"), of("g").alias("chunks")).filter("blocks > 0 and chunks > 0").select("grp", "blocks", "chunks")
    spot = lambda n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = hosts.join(plan, "grp").select("grp", "component", key, spot("blocks").alias("block"), every("chunks").alias("chunk"), F.lit(False).alias("guest"))
    others = guests.join(plan, "grp").select("grp", "component", key, every("blocks").alias("block"), spot("chunks").alias("chunk"), F.lit(True).alias("guest"))
    return own.union(others)
