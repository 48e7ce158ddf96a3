"""Geometry over boxes: structs of x0, y0, x1, y1 in points, y downwards. Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(prefix: str = "", alias: str | None = None) -> Column:
    """The box of columns x0 .. y1 (with a prefix, or of an aliased table)."""
    name = lambda k: f"{alias}.{k}" if alias else f"{prefix}{k}"
    return F.struct(*[F.col(name(k)).alias(k) for k in ("x0", "y0", "x1", "y1")])


def bbox(polygon: Column) -> Column:
    """Box of an array of [x, y] corners."""
    at = lambda i: F.transform(polygon, lambda p: F.get(p, F.lit(i)))
    return F.struct(F.array_min(at(0)).alias("x0"), F.array_min(at(1)).alias("y0"), F.array_max(at(0)).alias("x1"), F.array_max(at(1)).alias("y1"))


def width(b: Column) -> Column:
    return b["x1"] - b["x0"]


def height(b: Column) -> Column:
    return b["y1"] - b["y0"]


def area(b: Column) -> Column:
    return width(b) * height(b)


def center(b: Column) -> Column:
    return F.struct(((b["x0"] + b["x1"]) / 2).alias("x"), ((b["y0"] + b["y1"]) / 2).alias("y"))


def _box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))


def expand(b: Column, x: float, y: float) -> Column:
    """Grown on each side by fractions of its own size."""
    dx, dy = width(b) * x, height(b) * y
    return _box(b["x0"] - dx, b["y0"] - dy, b["x1"] + dx, b["y1"] + dy)


def rescale(b: Column, old: tuple[float, float], new: tuple[float, float]) -> Column:
    sx, sy = new[0] / old[0], new[1] / old[1]
    return _box(b["x0"] * sx, b["y0"] * sy, b["x1"] * sx, b["y1"] * sy)


def fit_to_bounds(b: Column, x0: float, y0: float, x1: float, y1: float) -> Column:
    inside = lambda v, lo, hi: F.greatest(F.least(v, F.lit(hi)), F.lit(lo))
    return _box(inside(b["x0"], x0, x1), inside(b["y0"], y0, y1), inside(b["x1"], x0, x1), inside(b["y1"], y0, y1))


def overlap_x(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]))


def overlap_y(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))


def intersection_area(a: Column, b: Column) -> Column:
    return overlap_x(a, b) * overlap_y(a, b)


def intersection_pct(a: Column, b: Column) -> Column:
    """Overlap as a share of ``a``; 0 for a box without area."""
    return F.when(area(a) == 0, 0.0).otherwise(intersection_area(a, b) / area(a))


def minimum_gap(a: Column, b: Column) -> Column:
    """Distance between the nearest edges or corners; 0 if they overlap."""
    dx = F.greatest(F.lit(0.0), a["x0"] - b["x1"], b["x0"] - a["x1"])
    dy = F.greatest(F.lit(0.0), a["y0"] - b["y1"], b["y0"] - a["y1"])
    return F.when(dx == 0, dy).when(dy == 0, dx).otherwise(F.sqrt(dx * dx + dy * dy))


def center_distance(a: Column, b: Column, x_weight: float = 1.0, y_weight: float = 1.0, absolute: bool = False) -> Column:
    dx = ((a["x0"] + a["x1"]) - (b["x0"] + b["x1"])) / 2
    dy = ((a["y0"] + a["y1"]) - (b["y0"] + b["y1"])) / 2
    if absolute:
        return F.abs(dx) * x_weight + F.abs(dy) * y_weight
    return F.sqrt(dx * dx * x_weight + dy * dy * y_weight)


def vertical_overlap_ratio(a: Column, b: Column) -> Column:
    """Vertical overlap as a share of the lower height."""
    low = F.least(height(a), height(b))
    return F.when(low <= 0, 0.0).otherwise(overlap_y(a, b) / low)


def normalize_bbox(b: Column, page_width: Column | float, page_height: Column | float) -> Column:
    """On a scale of 0 to 1000 of the page."""
    w, h = (F.lit(v) if isinstance(v, (int, float)) else v for v in (page_width, page_height))
    return _box(b["x0"] / w * 1000, b["y0"] / h * 1000, b["x1"] / w * 1000, b["y1"] / h * 1000)


def merge_boxes() -> list[Column]:
    """Aggregates for the enclosing box of columns x0 .. y1."""
    return [F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")]
