"""Review queue of labels the edge model was unsure about."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import LABEL_REVIEW_STATUS, align

# Confidence below which a label is queued, and the states of a review.
REVIEW_BELOW = 0.40
REVIEW_STATES = ("pending", "in_review", "reviewed", "rejected")


def review_queue(labels: DataFrame, as_of: Column, below: float = REVIEW_BELOW) -> DataFrame:
    """Labels with too little confidence as pending review rows; expects image_id, lines_gcs_uri, confidence, num_lines."""
    unsure = labels.filter(F.col("confidence") < below)
    return align(unsure.withColumns({"status": F.lit("pending"), "created_at": as_of}), LABEL_REVIEW_STATUS.schema)


def review_counts(reviews: DataFrame) -> DataFrame:
    """Rows per known state, 0 for a state without rows."""
    counts = reviews.agg(*[F.count_if(F.col("status") == s).alias(s) for s in REVIEW_STATES])
    pairs = F.array(*[F.struct(F.lit(s).alias("status"), F.col(s).alias("rows")) for s in REVIEW_STATES])
    return counts.select(F.inline(pairs))
