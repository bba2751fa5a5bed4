"""Geometry of normalized boxes, given as four columns (cx, cy, w, h)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def box(prefix: str = "", suffix: str = "") -> Box:
    """The columns cx, cy, w, h with a prefix or suffix; a prefix like ``x.`` reads a struct."""
    return tuple(F.col(f"{prefix}{c}{suffix}") for c in ("cx", "cy", "w", "h"))  # type: ignore[return-value]


def of_struct(s: Column) -> Box:
    return s["cx"], s["cy"], s["w"], s["h"]


def corners(b: Box) -> Box:
    """(left, top, right, bottom)."""
    cx, cy, w, h = b
    return cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2


def overlap(a: Box, b: Box, areas: str = "corners") -> Column:
    """Intersection over union, 0 where the union is empty.

    ``areas`` says from what a box's own area is computed: ``corners`` (clamped differences)
    or ``sides`` (w * h). The two can differ in the last bit.
    """
    al, at, ar, ab = corners(a)
    bl, bt, br, bb = corners(b)
    zero = F.lit(0.0)
    inner = F.greatest(zero, F.least(ar, br) - F.greatest(al, bl)) * F.greatest(zero, F.least(ab, bb) - F.greatest(at, bt))
    if areas == "corners":
        one = F.greatest(zero, ar - al) * F.greatest(zero, ab - at)
        two = F.greatest(zero, br - bl) * F.greatest(zero, bb - bt)
    else:
        one, two = a[2] * a[3], b[2] * b[3]
    union = one + two - inner
    return F.when(union > 0, inner / union).otherwise(zero)


def crosses_edge(b: Box) -> Column:
    left, top, right, bottom = corners(b)
    return (left < 0) | (top < 0) | (right > 1) | (bottom > 1)
