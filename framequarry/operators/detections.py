"""Detections as a table: kinds, confidence, boxes and counts per image."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import boxes as B


def kept_detections(detections: DataFrame, min_confidence: float = B.MIN_CONFIDENCE) -> DataFrame:
    """Detections at or above the confidence whose class is a face or a plate, with their `kind`."""
    return (
        detections.filter(F.col("conf") >= min_confidence)
        .withColumn("kind", B.detection_kind(F.col("class_name")))
        .filter(F.col("kind").isNotNull())
    )


def pixel_boxes(detections: DataFrame, width: Column, height: Column) -> DataFrame:
    """Boxes in whole pixels inside the picture; boxes with nothing left are dropped."""
    box = F.struct("x1", "y1", "x2", "y2")
    kept = detections.withColumn("_box", B.clamped(box, width, height)).filter(F.col("_box").isNotNull())
    return kept.withColumns({n: F.col(f"_box.{n}") for n in ("x1", "y1", "x2", "y2")}).drop("_box")


def redaction_counts(images: DataFrame, kept: DataFrame, key: str = "image_id") -> DataFrame:
    """Faces and plates per image, 0 where nothing was found; counted before boxes are clamped.

    Only sums are shuffled, pre-aggregated per task, so an image with very many boxes is no hot group.
    """
    counts = kept.groupBy(key).agg(
        F.count_if(F.col("kind") == "face").alias("faces"), F.count_if(F.col("kind") == "plate").alias("plates")
    )
    joined = images.join(counts, key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("faces", "plates")})
