"""What is still to be done: anti-joins against earlier results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import USER_IDENTITY, align
from ..session import stage
from .bloom import Bloom

# Audits older than this are redone; raw user objects expire after this.
REDO_AFTER = "INTERVAL 48 HOURS"
RAW_LIFETIME = "INTERVAL 24 HOURS"


def in_source(images: DataFrame, source: str, dataset: str | None = None) -> DataFrame:
    """Rows of a source and, if one is named, of a dataset; an empty name means no filter."""
    rows = images.filter(F.col("source") == source)
    return rows.filter(F.col("dataset") == dataset) if dataset else rows


def unclassified(images: DataFrame, classifications: DataFrame) -> DataFrame:
    """Images without a classification row. Only the key is read from the classifications."""
    return images.join(classifications.select("image_id"), "image_id", "left_anti")


def unprocessed(raw: DataFrame, audit: DataFrame, as_of: Column) -> DataFrame:
    """Raw images without an audit row in the last 48 hours.

    Where the audit is a scan of the table, its partition column `processed_date` keeps older days from being opened.
    """
    since = as_of - F.expr(REDO_AFTER)
    recent = audit.filter(F.col("processed_at") >= since)
    if "processed_date" in audit.columns:
        recent = recent.filter(F.col("processed_date") >= F.to_date(since))
    recent = recent.select("image_id")
    return raw.join(recent, "image_id", "left_anti")


def expired_unprocessed(raw: DataFrame, audit: DataFrame, as_of: Column) -> DataFrame:
    """Raw images past their lifetime that were never audited; a report, nothing is deleted."""
    old = raw.filter(F.col("modificationTime") < as_of - F.expr(RAW_LIFETIME))
    return old.join(audit.select("image_id"), "image_id", "left_anti")


def without_revoked(images: DataFrame, identity: DataFrame) -> DataFrame:
    """Images of users who did not withdraw; images without a user stay.

    The images are read once. Few users withdraw, and public images have no user at all: a Bloom filter of the withdrawn
    ids sorts out all but a few rows, and those rows get a key of their own that matches nothing. Where the ids are few
    enough to broadcast no image is shuffled; where they are not, the rows without a match are dealt out evenly,
    instead of all NULL keys or all images of one user to one task.
    """
    rows = align(identity, USER_IDENTITY.schema).filter(F.col("revoked_at").isNotNull() & F.col("user_id").isNotNull())
    revoked = stage(rows.select(F.col("user_id").alias("_revoked")).distinct(), "revoked")
    owner = F.col("user_id").cast("string")
    own_key = F.concat(F.lit("\0"), F.xxhash64(*[F.col(f"`{c}`") for c in images.columns]).cast("string"))
    keyed = images.withColumn("_owner", F.when(Bloom(revoked, "_revoked").may_hold(owner), owner).otherwise(own_key))
    return keyed.join(revoked, F.col("_owner") == F.col("_revoked"), "left_anti").drop("_owner")


def pseudonym(real_ref: Column, salt: str) -> Column:
    return F.concat(F.lit("usr_"), F.sha2(F.concat(F.lit(salt), real_ref), 256))


def first_by(df: DataFrame, key: str, limit: int | None) -> DataFrame:
    """The first `limit` rows by key (all without a limit); ordered, so a rerun takes the same rows."""
    return df if limit is None else df.orderBy(key).limit(limit)


def seeded_sample(df: DataFrame, key: str, count: int, seed: int) -> DataFrame:
    """`count` distinct rows in an order drawn from the seed, the same on any partitioning."""
    draw = F.md5(F.concat(F.col(key), F.lit(f"#{seed}")))
    return df.orderBy(draw, key).limit(count)
