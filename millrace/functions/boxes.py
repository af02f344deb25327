"""Bounding-box geometry as column expressions (corner format unless named)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Corners = tuple[Column, Column, Column, Column]


def corners(prefix: str = "") -> Corners:
    return tuple(F.col(f"{prefix}{n}") for n in ("x1", "y1", "x2", "y2"))


def area(b: Corners) -> Column:
    return (b[2] - b[0]) * (b[3] - b[1])


def iou(a: Corners, b: Corners, eps: float = 0.0) -> Column:
    """Overlap over union; 0 for boxes that do not overlap."""
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    inter = w * h
    union = area(a) + area(b) - inter + eps
    return F.when((w > 0) & (h > 0), F.coalesce(F.try_divide(inter, union), F.lit(0.0))).otherwise(F.lit(0.0))


def to_xywh(b: Corners) -> Corners:
    return b[0], b[1], b[2] - b[0], b[3] - b[1]


def from_xywh(b: Corners) -> Corners:
    return b[0], b[1], b[0] + b[2], b[1] + b[3]


def to_center(b: Corners) -> Corners:
    return (b[0] + b[2]) / 2, (b[1] + b[3]) / 2, b[2] - b[0], b[3] - b[1]


def from_center(b: Corners) -> Corners:
    return b[0] - b[2] / 2, b[1] - b[3] / 2, b[0] + b[2] / 2, b[1] + b[3] / 2


_READ = {"xyxy": lambda b: b, "xywh": from_xywh, "cxcywh": from_center}
_WRITE = {"xyxy": lambda b: b, "xywh": to_xywh, "cxcywh": to_center}


def convert(b: Corners, from_format: str, to_format: str) -> Corners:
    """Convert between ``xyxy``, ``xywh`` and ``cxcywh``."""
    if from_format not in _READ or to_format not in _WRITE:
        raise ValueError(f"unknown box format: {from_format} or {to_format}")
    return _WRITE[to_format](_READ[from_format](b))


def normalise(b: Corners, width: Column, height: Column) -> Corners:
    """Pixels to shares of the image."""
    return tuple(F.try_divide(v, s) for v, s in zip(b, (width, height, width, height)))


def denormalise(b: Corners, width: Column, height: Column) -> Corners:
    return tuple(v * s for v, s in zip(b, (width, height, width, height)))


def resize(b: Corners, old_w: Column, old_h: Column, new_w: Column, new_h: Column) -> Corners:
    sx, sy = F.try_divide(new_w, old_w), F.try_divide(new_h, old_h)
    return b[0] * sx, b[1] * sy, b[2] * sx, b[3] * sy


def clip(b: Corners, width: Column, height: Column) -> Corners:
    zero = F.lit(0.0)
    return tuple(
        F.greatest(zero, F.least(v, s.cast("double"))) for v, s in zip(b, (width, height, width, height))
    )


def letterbox(b: Corners, width: Column, height: Column, target: int) -> Corners:
    """Boxes after fitting the image into a padded square."""
    scale = F.least(F.lit(float(target)) / height, F.lit(float(target)) / width)
    pad_x = F.floor((target - F.floor(width * scale)) / 2)
    pad_y = F.floor((target - F.floor(height * scale)) / 2)
    return b[0] * scale + pad_x, b[1] * scale + pad_y, b[2] * scale + pad_x, b[3] * scale + pad_y


def mosaic(
    b: Corners, quadrant: Column, width: Column, height: Column, center_x: int, center_y: int, size: int
) -> Corners:
    """Boxes after placing the image in one of four quadrants (0 top-left .. 3)."""
    right, bottom = quadrant.isin(1, 3), quadrant.isin(2, 3)
    left_edge = F.when(right, F.lit(center_x)).otherwise(F.lit(0))
    top_edge = F.when(bottom, F.lit(center_y)).otherwise(F.lit(0))
    sx = F.when(right, F.lit(size - center_x)).otherwise(F.lit(center_x)) / width
    sy = F.when(bottom, F.lit(size - center_y)).otherwise(F.lit(center_y)) / height
    return b[0] * sx + left_edge, b[1] * sy + top_edge, b[2] * sx + left_edge, b[3] * sy + top_edge


def aspect_ratio(b: Corners) -> Column:
    return (b[2] - b[0]) / (b[3] - b[1] + 1e-6)


def decode_offsets(loc: Corners, prior: Corners) -> Corners:
    """Apply regression offsets to priors in centre format; corners within 0..1."""
    # Offset variances.
    center_var, size_var = 0.1, 0.2
    cx = prior[0] + loc[0] * center_var * prior[2]
    cy = prior[1] + loc[1] * center_var * prior[3]
    w = prior[2] * F.exp(loc[2] * size_var)
    h = prior[3] * F.exp(loc[3] * size_var)
    return tuple(F.greatest(F.lit(0.0), F.least(F.lit(1.0), v)) for v in from_center((cx, cy, w, h)))
