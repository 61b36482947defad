"""Session metadata of user uploads: one `meta.json` per user and session."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import paths as P
from ..functions.times import with_captured_at
from ..session import spread, stage
from .objects import read_objects


def session_starts(frames: DataFrame, raw_root: str) -> DataFrame:
    """Start of every session the frames belong to: one read per session, not per frame.

    Expects user_id and session_id; a session without usable metadata falls back to its name.
    """
    sessions = stage(frames.select("user_id", "session_id").distinct(), "sessions")
    sessions = spread(sessions, sessions.count(), "user_id", "session_id")
    uri = P.join_path(F.lit(raw_root), "user_id", "session_id", F.lit("meta.json"))
    read = read_objects(sessions.withColumn("_uri", uri), "_uri", as_text=True)
    return with_captured_at(read, "captured_at", F.col("content"), F.col("session_id")).select("user_id", "session_id", "captured_at")


def with_session_start(frames: DataFrame, sessions: DataFrame) -> DataFrame:
    """Frames with their session's `captured_at`.

    Sessions grow with the data, so nothing is broadcast by hand: adaptive execution broadcasts a small
    side and splits the partitions of a session that holds a large share of the frames.
    """
    return frames.join(sessions, ["user_id", "session_id"], "left")
