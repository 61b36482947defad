"""Work along a sequence of frames without gathering a sequence in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage

# A row number of `monotonically_increasing_id` has the partition above this bit.
PARTITION_BIT = 33


def frame_positions(df: DataFrame, sequence: str, frame_no: str, tie: str) -> DataFrame:
    """Add `position`, the 1-based place of a frame in its sequence, ordered by frame number and `tie`.

    All frames are sorted into ranges of about equal numbers of rows, whatever the frame numbers are, and staged with
    their row number. A sequence's rows stand together in each range, so a position is the row number moved by one
    figure per sequence and range; only those figures pass through a window. Rows without a sequence are one sequence.
    """
    order = [F.col(sequence), F.col(frame_no), F.col(tie)]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = stage(ranged, "frames").withColumn("_range", F.shiftright("_at", PARTITION_BIT))
    runs = placed.groupBy(F.col(sequence).alias("_s"), F.col("_range").alias("_r")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("_s").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    moves = runs.select("_s", "_r", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_move"))
    numbered = placed.join(moves, F.col(sequence).eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
    return numbered.withColumn("position", F.col("_at") + F.col("_move")).drop("_at", "_range", "_s", "_r", "_move")


def every_nth(df: DataFrame, sequence: str, frame_no: str, tie: str, n: int) -> DataFrame:
    """The first frame of every sequence and each n-th after it."""
    return frame_positions(df, sequence, frame_no, tie).filter((F.col("position") - 1) % n == 0)


def representatives(df: DataFrame, sequence: str, order: list[Column]) -> DataFrame:
    """One frame per sequence, the first by `order`; pre-aggregated, so a long sequence is one row per task."""
    whole = F.struct(*[F.col(c) for c in df.columns])
    rank = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    return df.groupBy(F.col(sequence).alias("_s")).agg(F.min_by(whole, rank).alias("_row")).select("_row.*")


def propagate(frames: DataFrame, labelled: DataFrame, sequence: str, order: list[Column], fields: list[str]) -> DataFrame:
    """Frames with the fields of their sequence's first labelled frame; NULL where a sequence has none.

    `frames` must not have the fields. The labels join back as one row per sequence; a hot sequence
    makes a skewed left side, which adaptive execution splits.
    """
    known = labelled.filter(F.forall(F.array(*[F.col(f).isNotNull() for f in fields]), lambda k: k))
    chosen = representatives(known, sequence, order).select(sequence, *fields)
    return frames.join(chosen, sequence, "left")
