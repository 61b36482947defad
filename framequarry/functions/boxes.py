"""Detections and boxes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .lanes import whole

# Detector confidence kept for recall, and blur kernel size.
MIN_CONFIDENCE = 0.1
BLUR_KERNEL = 31
# What the lower-case class name of each kind holds; the first kind that matches counts.
KIND_PATTERNS = {"face": "face", "plate": "plate|licen"}


def detection_kind(class_name: Column) -> Column:
    """`face`, `plate`, or NULL for a class to leave alone."""
    name = F.lower(class_name)
    return F.coalesce(*[F.when(name.rlike(pattern), F.lit(kind)) for kind, pattern in KIND_PATTERNS.items()])


def clamped(box: Column, width: Column, height: Column) -> Column:
    """Box in whole pixels inside the picture; NULL when nothing is left of it."""
    x1 = F.greatest(F.lit(0), whole(box.x1))
    y1 = F.greatest(F.lit(0), whole(box.y1))
    x2 = F.least(width.cast("bigint"), whole(box.x2))
    y2 = F.least(height.cast("bigint"), whole(box.y2))
    area = F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))
    return F.when((x2 > x1) & (y2 > y1), area)


def odd_kernel(radius: Column) -> Column:
    return radius + F.when(radius % 2 == 0, 1).otherwise(0)
