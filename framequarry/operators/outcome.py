"""Per-row outcomes, run summaries and exit codes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..session import stage


def label_status(df: DataFrame, ingest_unlabeled: Column, skip_missing: Column) -> DataFrame:
    """Add `status` and `error`: earlier errors fail, a missing label is taken, skipped or failed.

    Expects `has_label` and `label_error`.
    """
    missing = ~F.col("has_label")
    status = (
        F.when(F.col("label_error").isNotNull(), "error")
        .when(missing & ~ingest_unlabeled & skip_missing, "skipped")
        .when(missing & ~ingest_unlabeled, "error")
        .otherwise("ok")
    )
    error = F.coalesce(F.col("label_error"), F.when(F.col("status") == "error", F.lit("image without label")))
    return df.withColumn("status", status).withColumn("error", error)


def copy_action(df: DataFrame, target_exists: Column, overwrite: Column) -> DataFrame:
    """Add `reused`: a usable row whose target is there already and must not be overwritten."""
    return df.withColumn("reused", (F.col("status") == "ok") & target_exists & ~overwrite)


def split_outcome(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable rows and failed rows; skipped rows are in neither."""
    return df.filter(F.col("status") == "ok"), df.filter(F.col("status") == "error")


def _exit_code(failed: Column) -> Column:
    return F.when(failed > 0, 1).otherwise(0)


def ingest_summary(outcome: DataFrame, *by: str) -> DataFrame:
    """Counts of an ingest run, one row (or one per `by`)."""
    ok = F.col("status") == "ok"
    totals = outcome.groupBy(*by).agg(
        F.count_if(ok).alias("num_images"),
        F.count_if(ok & ~F.col("reused")).alias("written"),
        F.count_if(ok & F.col("reused")).alias("reused"),
        F.count_if(ok & ~F.col("has_label")).alias("unlabeled"),
        F.count_if(F.col("status") == "skipped").alias("skipped_no_label"),
        F.count_if(F.col("status") == "error").alias("failed"),
        # Splits are a handful of names, so the set stays small whatever the number of rows.
        F.array_sort(F.collect_set(F.when(ok, F.col("split")))).alias("splits"),
    )
    return totals.withColumn("exit_code", _exit_code(F.col("failed")))


def redaction_summary(outcome: DataFrame) -> DataFrame:
    """Counts of a redaction run over its candidates."""
    ok = F.col("status") == "ok"
    totals = outcome.agg(
        F.count("*").alias("candidates"), F.count("*").alias("processed"), F.count_if(ok).alias("anonymized"),
        F.coalesce(F.sum(F.when(ok, F.col("faces"))), F.lit(0)).alias("faces_blurred"),
        F.coalesce(F.sum(F.when(ok, F.col("plates"))), F.lit(0)).alias("plates_blurred"),
        F.count_if(~ok).alias("failed"),
    )
    return totals.withColumn("exit_code", _exit_code(F.col("failed")))


def labelling_summary(outcome: DataFrame) -> DataFrame:
    """Counts of a labelling run over its candidates."""
    ok = F.col("status") == "ok"
    totals = outcome.agg(
        F.count("*").alias("candidates"), F.count_if(ok).alias("classified"), F.count_if(~ok).alias("failed")
    )
    return totals.withColumn("exit_code", _exit_code(F.col("failed")))


def staged_with_progress(part: DataFrame, purpose: str, done: dict[str, int], progress: Callable[[dict[str, int]], None] | None) -> DataFrame:
    """Stage a slice of a run's outcome; its counts are observed as it is written, added to `done`, and told.

    Nothing is read a second time for it. `progress` gets the counts of all slices so far: slices, candidates, ok and failed.
    """
    counts = Observation()
    ok = F.col("status") == "ok"
    written = stage(part.observe(counts, F.count("*").alias("candidates"), F.count_if(ok).alias("ok"), F.count_if(~ok).alias("failed")), purpose)
    for name, value in (counts.get | {"slices": 1}).items():
        done[name] = done.get(name, 0) + value
    if progress:
        progress(dict(done))
    return written
