"""Ingest of a public dataset: descriptor, samples, labels, placed objects, manifests, catalogue rows."""

from __future__ import annotations

from collections.abc import Set
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from ..config import Layout
from ..functions import lanes as LN
from ..functions import paths as P
from ..functions.times import epoch_time
from ..operators import manifests as M
from ..operators import outcome as O
from ..operators import rows as R
from ..operators.object_io import place_samples
from ..operators.tables import CatalogueTable, key_collisions
from ..schemas import IMAGES, SOURCE_DATASETS
from ..session import spread, stage
from ..sources.descriptors import read_descriptor
from ..sources.formats import FORMATS, SPLITS, DatasetFormat, find_format, unreadable
from ..sources.objects import list_objects, read_objects, with_existence


@dataclass(frozen=True)
class IngestRun:
    """`outcome` has a row per sample; `summary` is one row; `collisions` are the ids of several usable samples, of
    which one became the catalogue row; `unreadable` are list files that could not be read, with their errors: such a run
    is aborted, records what the others name, and its repeat goes on from there. Nothing was written when `dry_run`."""

    dataset: str
    outcome: DataFrame
    summary: DataFrame
    collisions: DataFrame
    dry_run: bool
    unreadable: dict[str, str] = field(default_factory=dict)


def labelled_samples(samples: DataFrame, form: DatasetFormat, descriptor: Row) -> DataFrame:
    """Samples with whole-number lanes, `has_label`, and the status the label policy gives them."""
    read = form.parse(read_objects(samples, "label_uri", as_text=True), "content")
    rounded = read.withColumn("rounded", LN.whole_lanes(F.col("lanes")))
    gap = F.when(LN.has_gap(F.col("rounded")), F.lit("label: not a finite number"))
    known = rounded.withColumns({
        "has_label": F.col("found"),
        "label_error": F.coalesce(F.col("read_error"), F.col("label_error"), gap),
    })
    status = O.label_status(known, F.lit(descriptor.ingest_unlabeled), F.lit(descriptor.skip_missing_labels))
    return status.drop("content", "found", "read_error", "lanes")


def output_names(df: DataFrame, out_root: Column) -> DataFrame:
    return df.withColumns({
        "img_rel": P.image_out("split", "category", "rel_path"),
        "txt_rel": P.manifest_out("split", "category"),
        "gcs_uri": F.concat_ws("/", out_root, P.image_out("split", "category", "rel_path")),
        "label_out_uri": F.concat_ws("/", out_root, P.label_out("split", "category", "rel_path")),
    })


def _with_existing(df: DataFrame, objects: DataFrame | None) -> DataFrame:
    """Add whether a sample's image and label are in place; nothing is when there is no listing."""
    for uri, flag in (("gcs_uri", "_image_there"), ("label_out_uri", "_label_there")):
        df = df.withColumn(flag, F.lit(False)) if objects is None else with_existence(df, uri, objects, flag)
    return df


def _place(planned: DataFrame, overwrite: bool, epoch: int) -> DataFrame:
    """Copy images and write labels that are not there yet (all of them when overwriting)."""
    ok = F.col("status") == "ok"
    # Image and label are decided apart: a label lost between the two writes is made good by a rerun.
    wants_label = ok & F.col("has_label") & (F.lit(overwrite) | ~F.col("_label_there"))
    work = planned.withColumns({
        "_copy": ok & ~F.col("reused"),
        "_label": F.when(wants_label, LN.label_text(F.col("rounded"), F.lit(epoch))),
    }).drop("rounded")
    placed = place_samples(work, "_copy", "src_image_uri", "gcs_uri", "label_out_uri", "_label")
    return placed.withColumns({
        "error": F.coalesce("error", "write_error"),
        "status": F.when(F.col("write_error").isNotNull(), "error").otherwise(F.col("status")),
        "reused": F.col("reused") & F.col("write_error").isNull(),
    }).drop("write_error")


def ingest(
    spark: SparkSession, layout: Layout, dataset: str, epoch: int, dry_run: bool = False, limit: int | None = None,
    splits: Set[str] | None = None, formats: dict[str, DatasetFormat] = FORMATS,
) -> IngestRun:
    """Run one dataset. A bad descriptor raises; a bad sample only fails its row.

    Names are joined with the target listing first, while rows are small. Reading a label, judging it,
    copying the image and writing the label then happen in one pass over tasks sized for object access,
    so neither labels nor images are ever shuffled.
    """
    descriptor = read_descriptor(spark, layout.descriptors_root, dataset)
    form = find_format(descriptor.adapter, formats)
    raw_root, out_root = f"{layout.raw_public.rstrip('/')}/{dataset}", f"{layout.public.rstrip('/')}/{dataset}"

    def named(*without) -> DataFrame:
        samples = form.samples(spark, descriptor, raw_root, splits, *without)
        if limit is not None:
            samples = samples.orderBy("split", "category", "rel_path").limit(limit)
        return stage(output_names(samples, F.lit(out_root)), "ingest-samples")

    bad: dict[str, str] = {}
    try:
        samples = named()
    except Exception:  # noqa: BLE001 - raised again unless it is a list file that failed
        bad = unreadable(spark, form.lists(spark, descriptor, raw_root, splits)) if form.lists else {}
        if not bad:
            raise
        samples = named(set(bad))
    objects = None if dry_run else list_objects(spark, out_root + "/")
    known = spread(_with_existing(samples, objects), samples.count(), "gcs_uri")
    judged = labelled_samples(known, form, descriptor)
    planned = O.copy_action(judged, F.col("_image_there"), F.lit(descriptor.overwrite))
    done = planned.drop("rounded") if dry_run else _place(planned, descriptor.overwrite, epoch)
    outcome = stage(done.drop("_image_there", "_label_there"), "ingest-outcome")
    ok, _ = O.split_outcome(outcome)
    if not dry_run:
        _write_manifests(spark, ok, out_root, descriptor.overwrite)
        _write_rows(spark, layout, ok, descriptor, dataset, out_root, epoch)
    summary = O.ingest_summary(outcome).withColumn("aborted", F.lit(bool(bad)))
    summary = summary.withColumn("exit_code", F.when(F.col("aborted"), 1).otherwise(F.col("exit_code")))
    return IngestRun(dataset, outcome, summary, key_collisions(ok, IMAGES.key), dry_run, bad)


def _write_manifests(spark: SparkSession, ok: DataFrame, out_root: str, overwrite: bool) -> None:
    new = stage(ok.select("txt_rel", F.col("img_rel").alias("path")).distinct(), "manifest-new")
    # A rerun that finds nothing new compares fingerprints; the old lines of other manifests are read and merged.
    prints = M.fingerprints(new)
    names = sorted(prints.keys() - M.unchanged(spark, prints, out_root))
    if not names:
        return
    new = new.filter(F.col("txt_rel").isin(names))
    old = M.read_manifests(spark, out_root, names)
    M.write_manifests(M.merged_lines(new, None if overwrite else old, names), old, out_root)
    M.remember(spark, {name: prints[name] for name in names}, out_root)


def _write_rows(spark, layout: Layout, ok: DataFrame, descriptor: Row, dataset: str, out_root: str, epoch: int) -> None:
    as_of = epoch_time(epoch)
    split_rank = F.array_position(F.array(*[F.lit(s) for s in SPLITS]), F.col("split"))
    # One key may come from two splits or categories; the first split, then the first output path, wins.
    rows = R.public_rows(ok, as_of)
    CatalogueTable(spark, layout.table_path(IMAGES.name), IMAGES).upsert(rows, order=[split_rank, F.col("gcs_uri")])
    described = ok.withColumns({
        "run_dataset": F.lit(dataset), "version": F.lit(descriptor.version), "license": F.lit(descriptor.license),
        "gcs_prefix": F.lit(out_root), "source_url": F.lit(descriptor.source_url), "notes": F.lit(descriptor.notes),
    })
    versions = R.dataset_rows(described, as_of)
    CatalogueTable(spark, layout.table_path(SOURCE_DATASETS.name), SOURCE_DATASETS).upsert(versions)
