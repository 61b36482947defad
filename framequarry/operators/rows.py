"""Rows of the catalogue tables from job outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import notes_text
from ..schemas import IMAGES, SOURCE_DATASETS, USER_IMAGES_PRIVACY, align


def public_rows(ok: DataFrame, as_of: Column) -> DataFrame:
    """Catalogue rows of a public dataset; `gcs_uri` is the normalised image."""
    rows = ok.withColumns({
        "source": F.lit("public"), "ingested_at": as_of,
        "user_id": F.lit(None).cast("string"), "captured_at": F.lit(None).cast("timestamp"),
    })
    return align(rows, IMAGES.schema)


def dataset_rows(ok: DataFrame, as_of: Column) -> DataFrame:
    """One row per dataset version with its number of usable images; none without usable images.

    Expects `run_dataset`, `version`, `license`, `gcs_prefix`, `source_url` and `notes` on every row.
    """
    version = F.coalesce(F.col("version"), F.lit(""))
    counted = ok.groupBy(F.col("run_dataset").alias("dataset"), version.alias("version")).agg(
        F.count("*").alias("num_images"),
        F.max(F.nullif(F.col("license"), F.lit(""))).alias("license"),
        F.max("gcs_prefix").alias("gcs_prefix"),
        F.max(notes_text(F.col("source_url"), F.col("notes"))).alias("notes"),
    )
    return align(counted.withColumn("normalized_at", as_of), SOURCE_DATASETS.schema)


def audit_rows(ok: DataFrame, as_of: Column, model_version: str) -> DataFrame:
    """Redaction audit; expects image_id, raw_uri, clean_uri, faces, plates."""
    rows = ok.select(
        "image_id", F.col("raw_uri").alias("raw_gcs_uri"), F.col("clean_uri").alias("clean_gcs_uri"),
        F.col("faces").alias("faces_blurred"), F.col("plates").alias("plates_blurred"),
        as_of.alias("processed_at"), F.lit(model_version).alias("model_version"),
    )
    return align(rows, USER_IMAGES_PRIVACY.schema)


def user_rows(ok: DataFrame, as_of: Column) -> DataFrame:
    """Catalogue rows of redacted user images; they have no split."""
    rows = ok.select(
        "image_id", F.lit("user").alias("source"), F.lit("user").alias("dataset"), F.col("clean_uri").alias("gcs_uri"),
        "width", "height", "frame_id", F.col("session_id").alias("sequence_id"), "user_id", "captured_at",
        as_of.alias("ingested_at"),
    )
    return align(rows, IMAGES.schema)
