"""Redaction of user images: list, skip what was done lately, redact, audit, catalogue."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import Layout
from ..functions import paths as P
from ..functions.boxes import BLUR_KERNEL, MIN_CONFIDENCE
from ..functions.times import epoch_time
from ..operators import outcome as O
from ..operators import pending as PD
from ..operators import rows as R
from ..operators.redact import BATCH, Codec, Detector, redact_objects
from ..operators.tables import CatalogueTable
from ..schemas import IMAGES, USER_IMAGES_PRIVACY
from ..session import spread, stage
from ..sources.objects import list_objects, user_images, with_existence
from ..sources.sessions import session_starts, with_session_start


@dataclass(frozen=True)
class RedactionRun:
    outcome: DataFrame
    summary: DataFrame
    dry_run: bool


def raw_frames(objects: DataFrame, layout: Layout) -> DataFrame:
    """Raw user images with their ids, target URIs and whether a lane file lies beside them."""
    raw, clean = layout.raw_user, layout.clean_user
    rel = P.below("path", raw)
    frames = user_images(objects).select(
        F.col("path").alias("raw_uri"), P.user_image_id("path", raw).alias("image_id"),
        P.swap_root("path", raw, clean).alias("clean_uri"), P.lines_uri("path").alias("raw_lines"),
        P.path_user(rel).alias("user_id"), P.path_session(rel).alias("session_id"), P.path_frame(rel).alias("frame_id"),
    )
    known = with_existence(frames, "raw_lines", objects, "has_lines")
    lines = F.when(F.col("has_lines"), F.col("raw_lines"))
    return known.withColumn("raw_lines", lines).withColumn("clean_lines", P.swap_root("raw_lines", raw, clean))


def redact_user_images(
    spark: SparkSession, layout: Layout, detector: Detector, codec: Codec, model_version: str, epoch: int,
    dry_run: bool = False, limit: int | None = None, slices: int = 1,
    min_confidence: float = MIN_CONFIDENCE, kernel: int = BLUR_KERNEL, batch: int = BATCH,
    progress: Callable[[dict[str, int]], None] | None = None,
) -> RedactionRun:
    """Redact what has no audit row of the last 48 hours.

    With `slices` above 1 the work is cut by a hash of the key and recorded slice by slice, so a run that
    is cut short keeps what it has finished; a rerun takes up the rest through the same anti-join. `progress` is told the
    counts so far whenever a slice is done.
    """
    as_of = epoch_time(epoch)
    audit = CatalogueTable(spark, layout.table_path(USER_IMAGES_PRIVACY.name), USER_IMAGES_PRIVACY)
    images = CatalogueTable(spark, layout.table_path(IMAGES.name), IMAGES)
    objects = list_objects(spark, layout.raw_user.rstrip("/") + "/")
    targets = PD.unprocessed(raw_frames(objects, layout), audit.scan(), as_of)
    # Staged, because the audit changes while the slices are worked off.
    targets = stage(PD.first_by(targets, "raw_uri", limit), "redaction-targets")
    rows = targets.count()

    parts, done = [], {}
    for number in range(slices):
        todo = targets.filter(F.pmod(F.xxhash64("image_id"), F.lit(slices)) == number)
        redacted = redact_objects(
            spread(todo, math.ceil(rows / slices), "image_id"), "raw_uri", "clean_uri", detector, codec,
            dry_run, "raw_lines", "clean_lines", min_confidence, kernel, batch,
        )
        status = F.when(F.col("error").isNull(), "ok").otherwise("error")
        part = O.staged_with_progress(redacted.withColumn("status", status), "redaction-outcome", done, progress)
        if not dry_run:
            ok, _ = O.split_outcome(part)
            timed = stage(with_session_start(ok, session_starts(ok, layout.raw_user)), "redaction-timed")
            # The catalogue first: should the run die between the two, the frames are still pending.
            images.upsert(R.user_rows(timed, as_of))
            audit.upsert(R.audit_rows(ok, as_of, model_version))
        parts.append(part)
    outcome = parts[0]
    for part in parts[1:]:
        outcome = outcome.unionByName(part)
    return RedactionRun(outcome, O.redaction_summary(outcome), dry_run)
