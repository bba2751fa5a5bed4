"""Near-duplicate embeddings by cross-polytope hashing after fast Hadamard rotations.

Equal vectors form one class. In each of several tables a class is hashed by the
nearest signed axes after pseudo-random rotations (three rounds of random signs and a
fast Hadamard transform each). Every class is filed in its own bucket and probes the
buckets next to it, in which some axes are the second nearest. The more classes there
are, the more axes make a hash, so that buckets do not fill with chance neighbours.
Candidates whose sign sketches are too far apart for any hope go at once; the others
are confirmed by cosine in double precision.

Groups are joined as for documents: first each bucket's members with its smallest
member, then, where a bucket's members are still in different components, the members
outside its largest component with all others, in blocks where a bucket holds many.
A vector's links are counted within its component without listing pairs: two vectors
within half the threshold's angle of their component's centre are near each other for
certain; only vectors further out are compared with all of the component, in blocks.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing; vectors of different lengths do not link. Rows without an id are
counted as links of others but have no component of their own. Extra columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.operators.components import connected_components
from sievemark.plans.tables import apart, cut

from .common import in_blocks, mix, ship

#: Of a hash with so many axes: tables, and further buckets probed in each. A pair of cosine 0.95 meets in none of them once in 5000.
SHAPES = {3: (10, 4), 4: (14, 8), 5: (18, 16)}
#: Axes are added while a class would meet more classes than this by chance.
CHANCE = 32
#: Least cosine, rows of a block, and the seed of the rotations' signs.
COSINE, BLOCK_ROWS, SEED = 0.95, 256, 11
#: Buckets with so many classes are compared in blocks.
LARGE = 64
#: Bits of a sketch; candidates that differ in more than FAR_BITS are no links (13 are expected at cosine 0.95, 64 at 0).
SKETCH_BITS, FAR_BITS = 128, 40


def axes_for(classes: int, width: int) -> int:
    """Axes of a hash for so many vectors of ``width`` numbers."""
    for axes, (tables, probes) in SHAPES.items():
        if 2 * classes * tables * (1 + probes) <= CHANCE * (2 * padded(width)) ** axes:
            return axes
    return max(SHAPES)


def padded(width: int) -> int:
    return max(2, 1 << (width - 1).bit_length())


def hadamard(x: np.ndarray) -> np.ndarray:
    """The unnormalised Hadamard transform of each column, in place; the height is a power of two."""
    step = 1
    while step < len(x):
        v = x.reshape(len(x) // (2 * step), 2, step, -1)
        total = v[:, 0] + v[:, 1]
        v[:, 1] = v[:, 0] - v[:, 1]
        v[:, 0] = total
        step *= 2
    return x


def rotated(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Columns after a pseudo-random rotation."""
    y = x
    for _ in range(3):
        y = hadamard(y * rng.choice([-1.0, 1.0], size=(len(x), 1)))
        y /= math.sqrt(len(x))
    return y


def _columns(x: np.ndarray) -> np.ndarray:
    out = np.zeros((padded(x.shape[1]), len(x)))
    out[: x.shape[1]] = x.T
    return out


def buckets(x: np.ndarray, axes: int, tables: int | None = None, probes: int | None = None) -> np.ndarray:
    """For each row and table the own bucket and the probed ones: rows x tables x (1 + probes)."""
    tables, probes = SHAPES[axes][0] if tables is None else tables, SHAPES[axes][1] if probes is None else probes
    n, d = x.shape
    columns = _columns(x)
    width = len(columns)
    rng = np.random.default_rng([SEED, d])
    row = np.arange(n)
    # Changes of some axes to their second nearest.
    subsets = np.array(sorted(range(1, 2**axes), key=lambda s: (s.bit_count(), s)))
    out = np.zeros((n, tables, 1 + min(probes, len(subsets))), dtype=np.uint64)
    for t in range(tables):
        choices = np.empty((axes, n, 2), dtype=np.int64)
        loss = np.empty((axes, n))
        for a in range(axes):
            y = rotated(columns, rng).T.copy()
            size = np.abs(y)
            first = size.argmax(axis=1)
            top = size[row, first]
            size[row, first] = -1.0
            second = size.argmax(axis=1)
            loss[a] = top - size[row, second]
            choices[a, :, 0] = first * 2 + (y[row, first] < 0)
            choices[a, :, 1] = second * 2 + (y[row, second] < 0)
        # Probes in order of what their axes lose in all.
        total = np.stack([sum(loss[a] for a in range(axes) if s >> a & 1) for s in subsets.tolist()], axis=1)
        swaps = np.concatenate([np.zeros((n, 1), dtype=np.int64), subsets[np.argsort(total, axis=1, kind="stable")[:, :probes]]], axis=1)
        key = np.full(swaps.shape, t * 65536 + d, dtype=np.uint64)
        for a in range(axes):
            key = mix(key * np.uint64(2 * width) + np.where(swaps >> a & 1, choices[a, :, 1:2], choices[a, :, 0:1]).astype(np.uint64))
        out[:, t, :] = key
    return out


def sketches(x: np.ndarray) -> np.ndarray:
    """The signs of each row after rotations: two numbers of 64 bits each; zeros for short vectors, which few rotations tell apart."""
    if x.shape[1] < 16:
        return np.zeros((len(x), 2), dtype=np.int64)
    columns, rng = _columns(x), np.random.default_rng([SEED + 1, x.shape[1]])
    signs = np.concatenate([rotated(columns, rng) >= 0 for _ in range(math.ceil(SKETCH_BITS / len(columns)))])[:SKETCH_BITS]
    return np.packbits(signs, axis=0).T.copy().view(np.int64)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _classes(vectors: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, key) for all vectors, key null if it cannot link; rows (key, rep, copies, v) for the classes."""
    v = F.transform(F.col(vector), lambda x: x.cast("double") + F.lit(0.0))  # -0.0 equals 0.0
    fine = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    # Two hashes of 64 bits that have nothing in common: equal vectors, and only these, are one class.
    part = lambda seed: F.lpad(F.hex(F.xxhash64(F.lit(seed), "v", F.size("v"))), 16, "0")
    rows = vectors.select(F.col(vec_id).alias("vec_id"), v.alias("v")).withColumn("key", F.when(fine, F.unhex(F.concat(part(1), part(2)))))
    return rows.select("vec_id", "key"), rows.filter("key is not null").groupBy("key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))


def _hashed(classes: DataFrame, axes: dict[int, int]) -> DataFrame:
    """Rows (key, rep, copies, u, s, t, own, probes): unit vectors, sketches, own and probed buckets."""
    ship(__name__)

    def run(batches):
        for b in batches:
            sizes = np.diff(b.column("v").offsets.to_numpy())
            flat, starts = b.column("v").flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                unit = _unit(flat[starts[at][:, None] + np.arange(d)])
                key = buckets(unit, axes[d]).view(np.int64)
                sketch = sketches(unit)
                lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(np.ascontiguousarray(x).reshape(-1)))
                taken = [b.column(c).take(pa.array(at)) for c in ("key", "rep", "copies")]
                made = [lists(unit), pa.array(sketch[:, 0]), pa.array(sketch[:, 1]), lists(key[:, :, 0]), lists(key[:, :, 1:].reshape(len(at), -1))]
                yield pa.RecordBatch.from_arrays([*taken, *made], names=["key", "rep", "copies", "u", "s", "t", "own", "probes"])

    rep = classes.schema["rep"].dataType.simpleString()
    return classes.mapInArrow(run, f"key binary, rep {rep}, copies bigint, u array<double>, s bigint, t bigint, own array<bigint>, probes array<bigint>")


def _filed(hashed: DataFrame) -> DataFrame:
    """Rows (id, s, t, bucket, own): where each class is filed (own) and where it probes."""
    row = lambda c, own: hashed.select("id", "s", "t", F.explode(c).alias("bucket"), F.lit(own).alias("own"))
    return row("own", True).union(row(F.array_except("probes", "own"), False))


def _hopeful(a: str, b: str) -> Column:
    """Whether the sketches of the rows or structs ``a`` and ``b`` are near enough for a link."""
    differ = lambda c: F.bit_count(F.col(f"{a}{c}").bitwiseXOR(F.col(f"{b}{c}")))
    return differ("s") + differ("t") <= FAR_BITS


def _cosine(a: str, b: str) -> Column:
    """Of two unit vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def _confirmed(pairs: DataFrame, hashed: DataFrame, cosine: float) -> DataFrame:
    """The pairs (a, b) with at least that cosine."""
    sides = pairs.join(hashed.select(F.col("id").alias("a"), F.col("u").alias("x")), "a").join(hashed.select(F.col("id").alias("b"), F.col("u").alias("y")), "b")
    return sides.filter("size(x) = size(y)").filter(_cosine("x", "y") >= cosine).select("a", "b")


def _near(x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of ``x`` are near which of ``y``; both have unit rows."""
    product = x @ y.T
    near = product >= cosine
    # Right at the threshold, sums in another order could differ from the pairwise ones.
    for i, j in zip(*np.nonzero(np.abs(product - cosine) < 1e-12), strict=True):
        near[i, j] = np.add.accumulate(x[i] * y[j])[-1] >= cosine
    return near


def _across_blocks(hosts: DataFrame, guests: DataFrame, hashed: DataFrame, cosine: float) -> DataFrame:
    """Links (a, b) of guests to hosts of the same ``grp`` in other components; of a block, one to each component."""
    ship(__name__)
    rows = in_blocks(hosts, guests, BLOCK_ROWS, "id").join(hashed.select("id", "u"), "id").withColumn("d", F.size("u"))

    def check(pdf):
        own, guests = pdf[~pdf["guest"]], pdf[pdf["guest"]]
        found = []
        if len(own) and len(guests):
            near = _near(np.stack(guests["u"]), np.stack(own["u"]), cosine)
            near &= guests["component"].to_numpy()[:, None] != own["component"].to_numpy()[None, :]
            names, part = own["id"].to_numpy(), pd.factorize(own["component"])[0]
            for key, row in zip(guests["id"], near, strict=True):
                hit = np.flatnonzero(row)
                found += [(key, names[hit[i]]) for i in np.unique(part[hit], return_index=True)[1]]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return rows.groupBy("grp", "block", "chunk", "d").applyInPandas(check, "a bigint, b bigint")


def _counted(members: DataFrame, hashed: DataFrame, cosine: float) -> DataFrame:
    """Rows (id, others): for each class of a component (id, component) how many vectors link with each of its own.

    Counted are the vectors of other classes and the class's own copies but one.
    """
    ship(__name__)
    m = cut(members.join(hashed.select("id", "copies", "u"), "id"))
    sums = m.select("component", F.posexplode("u").alias("at", "x")).groupBy("component", "at").agg(F.sum("x").alias("x"))
    centre = sums.groupBy("component").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda p: p["x"]).alias("c"))  # a number for each of a vector's
    centre = cut(centre.select("component", "c", F.sqrt(_cosine("c", "c")).alias("norm")))
    # Two vectors within half the angle of the centre are within the angle of each other; the margin is for rounding.
    within = F.lit(math.sqrt((1 + cosine) / 2) + 1e-9)
    placed = m.join(centre, "component").withColumn("inner", _cosine("u", "c") >= within * F.col("norm"))
    placed = cut(placed.select("id", "component", "copies", "inner"))
    totals = placed.groupBy("component", apart("component")).agg(F.sum(F.when(F.col("inner"), F.col("copies")).otherwise(0)).alias("sure"), F.bool_or(~F.col("inner")).alias("open"))
    placed = cut(placed.join(totals.drop("__apart"), "component"))
    rim = in_blocks(placed.filter("open").withColumn("grp", F.col("component")), placed.filter(~F.col("inner")).withColumn("grp", F.col("component")), BLOCK_ROWS, "id")
    rim = rim.join(m.select("id", "copies", "u"), "id").join(placed.select("id", "inner"), "id").select("grp", "block", "chunk", "guest", "id", "copies", "inner", "u")

    def count(pdf):
        hosts, guests = pdf[~pdf["guest"]], pdf[pdf["guest"]]
        if not len(hosts) or not len(guests):
            return pd.DataFrame({"id": [], "others": []}, dtype=np.int64)
        near = _near(np.stack(guests["u"]), np.stack(hosts["u"]), cosine) & (guests["id"].to_numpy()[:, None] != hosts["id"].to_numpy()[None, :])
        back = hosts["inner"].to_numpy()  # the outer ones are guests themselves
        own = pd.DataFrame({"id": guests["id"], "others": near @ hosts["copies"].to_numpy()})
        return pd.concat([own, pd.DataFrame({"id": hosts["id"][back], "others": guests["copies"].to_numpy() @ near[:, back]})])

    sure = placed.select("id", (F.when(F.col("inner"), F.col("sure")).otherwise(F.col("copies")) - 1).alias("others"))
    return sure.union(rim.groupBy("grp", "block", "chunk").applyInPandas(count, "id bigint, others bigint")).groupBy("id").agg(F.sum("others").alias("others"))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept) for each vector."""
    rows, classes = _classes(vectors, vec_id, vector)
    classes = cut(classes)
    lengths = {r["d"]: r["n"] for r in classes.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each length of vector
    hashed = cut(_hashed(classes, {d: axes_for(n, d) for d, n in lengths.items()}).withColumn("id", F.monotonically_increasing_id()))
    filed = _filed(hashed)
    centres = filed.groupBy("bucket", apart("bucket")).agg(F.min(F.when(F.col("own"), F.struct("id", "s", "t"))).alias("c"), F.count(F.lit(1)).alias("n")).filter("n > 1 and c is not null").select("bucket", "c")
    shared = cut(filed.join(centres, "bucket"))
    star = shared.filter(F.col("id") != F.col("c.id")).filter(_hopeful("", "c.")).select(F.least("id", "c.id").alias("a"), F.greatest("id", "c.id").alias("b")).distinct()
    links = cut(_confirmed(star, hashed, cosine))
    first = connected_components(links, "a", "b").withColumnRenamed("node", "id")

    placed = cut(shared.drop("c").join(first, "id", "left").withColumn("component", F.coalesce("component", "id")))
    counted = cut(placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("size")))
    mixed = counted.groupBy("bucket", apart("bucket")).agg(F.max(F.struct("size", "component")).alias("largest"), F.count(F.lit(1)).alias("parts"), F.sum("size").alias("size")).filter("parts > 1")
    mixed = cut(mixed.select("bucket", F.col("largest.component").alias("main"), (F.col("size") >= LARGE).alias("busy")))
    there = cut(placed.join(mixed, "bucket"))
    outside = there.filter("component <> main")
    # Buckets with many members are compared in blocks, the others pair by pair.
    in_busy = lambda df: df.filter("busy").select(F.col("bucket").alias("grp"), "component", "id")
    blocks = _across_blocks(in_busy(there), in_busy(outside), hashed, cosine)
    other = there.filter("not busy").select("bucket", F.struct("id", "s", "t", "component", "own").alias("o"))
    across = outside.filter("not busy").join(other, "bucket").filter(F.col("component") != F.col("o.component")).filter("own or o.own").filter(_hopeful("", "o."))
    across = across.select(F.least("id", "o.id").alias("a"), F.greatest("id", "o.id").alias("b")).distinct()
    more = cut(_confirmed(across, hashed, cosine).union(blocks))
    final = cut(connected_components(links.union(more), "a", "b").withColumnRenamed("node", "id"))

    named = final.join(hashed.select("id", "key", "rep"), "id").join(_counted(final, hashed, cosine), "id")
    named = cut(named.select("component", "key", "rep", "others"))
    least = named.groupBy("component", apart("component")).agg(F.min("rep").alias("component_id"))
    linked = cut(named.join(least, "component").select("key", "others", "component_id"))
    alone = classes.join(linked, "key", "left_anti").filter("copies > 1").select("key", (F.col("copies") - 1).alias("others"), F.col("rep").alias("component_id"))
    labels = cut(linked.union(alone))
    result = rows.join(labels, "key", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return result.select("vec_id", F.coalesce("others", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
