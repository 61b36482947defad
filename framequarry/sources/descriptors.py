"""Dataset descriptors: one YAML document per dataset."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from ..session import small_frame
from .objects import list_objects, read_objects
from .store import problem

SCHEMA = (
    "path string, run_dataset string, dataset string, version string, license string, source_url string, notes string, "
    "adapter string, image_ext string, overwrite boolean, skip_missing_labels boolean, ingest_unlabeled boolean, "
    "list_dir string, label_dir string, error string"
)


def _text(value) -> str | None:
    return None if value in (None, "") else str(value)


def _fields(text: str | None) -> dict:
    """Fields of a descriptor with the defaults of its options."""
    import yaml

    document = yaml.safe_load(text or "") or {}
    if not isinstance(document, dict):
        raise ValueError("descriptor is not a mapping")
    options = document.get("options") or {}
    if not document.get("adapter"):
        raise ValueError("descriptor does not define 'adapter'")
    names = ("dataset", "version", "license", "source_url", "notes", "adapter")
    return {
        **{name: _text(document.get(name)) for name in names},
        "image_ext": _text(document.get("image_ext")) or ".jpg",
        "overwrite": bool(options.get("overwrite", False)),
        "skip_missing_labels": bool(options.get("skip_missing_labels", True)),
        "ingest_unlabeled": bool(options.get("ingest_unlabeled", False)),
        "list_dir": _text(options.get("list_dir")),
        "label_dir": _text(options.get("label_dir")),
    }


def _parse(batches: Iterator) -> Iterator:
    import pandas as pd

    columns = [part.split()[0] for part in SCHEMA.split(",")]
    for pdf in batches:
        rows = []
        for path, name, text, found, error in zip(pdf.path, pdf.run_dataset, pdf.content, pdf.found, pdf.read_error):
            row = {"path": path, "run_dataset": name}
            try:
                if not found:
                    raise FileNotFoundError(error or path)
                row.update(_fields(text))
            except Exception as failure:  # noqa: BLE001 - becomes the row's error
                row["error"] = problem(failure)
            rows.append(row)
        yield pd.DataFrame(rows, columns=columns, dtype=object)


def parse_descriptors(names: DataFrame) -> DataFrame:
    """Descriptors named by `path` and `run_dataset`; an unusable one has an `error`."""
    return read_objects(names.select("path", "run_dataset"), "path", as_text=True).mapInPandas(_parse, SCHEMA)


def scan_descriptors(spark: SparkSession, root: str) -> DataFrame:
    """All descriptors of a folder except the template."""
    name = F.substring_index("path", "/", -1)
    files = list_objects(spark, root.rstrip("/") + "/").filter(F.endswith(name, F.lit(".yml")) & (name != "default.yml"))
    return parse_descriptors(files.select("path", F.regexp_replace(name, r"\.yml$", "").alias("run_dataset")))


def first_valid(descriptors: DataFrame) -> DataFrame:
    """The first usable descriptor by path."""
    return descriptors.filter(F.col("error").isNull()).orderBy("path").limit(1)


def read_descriptor(spark: SparkSession, root: str, dataset: str) -> Row:
    """One dataset's descriptor; raises when it is missing or unusable."""
    path = f"{root.rstrip('/')}/{dataset}.yml"
    row = parse_descriptors(small_frame(spark, [(path, dataset)], "path string, run_dataset string")).first()
    if row.error:
        raise ValueError(f"descriptor of {dataset!r}: {row.error}")
    return row
