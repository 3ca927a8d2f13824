"""Box arithmetic. A box is a struct (or four columns) x0, y0, x1, y1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x0: Column | str, y0: Column | str, x1: Column | str, y1: Column | str) -> Column:
    return F.struct(*[(F.col(v) if isinstance(v, str) else v).cast("double").alias(n) for n, v in zip(("x0", "y0", "x1", "y1"), (x0, y0, x1, y1), strict=True)])


def area(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b["x1"] - b["x0"]) * F.greatest(F.lit(0.0), b["y1"] - b["y0"])


def intersection(a: Column, b: Column) -> Column:
    w = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    h = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.when((w > 0) & (h > 0), w * h).otherwise(0.0)


def ioa(a: Column, b: Column) -> Column:
    """The share of a that lies in b; 0 for a box without area."""
    return F.when(area(a) > 0, intersection(a, b) / area(a)).otherwise(0.0)


def envelope(b: Column) -> Column:
    """Aggregate: the least box around all."""
    return F.struct(F.min(b["x0"]).alias("x0"), F.min(b["y0"]).alias("y0"), F.max(b["x1"]).alias("x1"), F.max(b["y1"]).alias("y1"))


def expand(b: Column, pad: float, width: Column, height: Column) -> Column:
    return box(F.greatest(F.lit(0.0), b["x0"] - pad), F.greatest(F.lit(0.0), b["y0"] - pad), F.least(width.cast("double"), b["x1"] + pad), F.least(height.cast("double"), b["y1"] + pad))


def percent_to_center(x: Column, y: Column, w: Column, h: Column) -> Column:
    """Percent (corner, size) -> fractions (center, size), clipped to the image; null when next to nothing is left."""
    clip = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
    x1, y1, x2, y2 = clip(x / 100), clip(y / 100), clip(x / 100 + w / 100), clip(y / 100 + h / 100)
    out = F.struct(((x1 + x2) / 2).alias("cx"), ((y1 + y2) / 2).alias("cy"), (x2 - x1).alias("w"), (y2 - y1).alias("h"))
    return F.when((x2 - x1 > 1e-4) & (y2 - y1 > 1e-4), out)


def center_to_corners(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    return box((cx - w / 2) * width, (cy - h / 2) * height, (cx + w / 2) * width, (cy + h / 2) * height)


def pixels_to_percent(b: Column, width: Column, height: Column) -> Column:
    """Clipped to the image; null when inverted or empty."""
    x0, y0 = F.greatest(F.lit(0.0), b["x0"]), F.greatest(F.lit(0.0), b["y0"])
    x1, y1 = F.least(width.cast("double"), b["x1"]), F.least(height.cast("double"), b["y1"])
    out = F.struct((100 * x0 / width).alias("x"), (100 * y0 / height).alias("y"), (100 * (x1 - x0) / width).alias("width"), (100 * (y1 - y0) / height).alias("height"))
    return F.when((x1 > x0) & (y1 > y0), out)


def crop_offset(b: Column, crop: Column) -> Column:
    """A box found inside a crop, in page coordinates."""
    return box(b["x0"] + crop["x0"], b["y0"] + crop["y0"], b["x1"] + crop["x0"], b["y1"] + crop["y0"])


def affine(b: Column, zoom: Column) -> Column:
    """Points to pixels."""
    return box(b["x0"] * zoom, b["y0"] * zoom, b["x1"] * zoom, b["y1"] * zoom)
