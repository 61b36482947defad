"""Dataset formats: from a descriptor to one row per image, all with the same schema.

The small part of a dataset (which list files there are, where images and labels lie) is found first, as
ranked candidates that are joined to a listing or looked up; the large part (list lines, folder listings) is
read as DataFrames with those answers as literals.
"""

from __future__ import annotations

from collections.abc import Callable, Set
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from ..functions import lanes as LN
from ..functions import paths as P
from ..functions.text import INNER_BREAK, LINE_BREAK, NOT_SPACE, stripped
from ..schemas import SAMPLES, align
from ..session import small_frame
from .objects import list_objects, with_presence
from .store import Store, problem

# The folders and list files of the two formats, and the picture size of the first.
SPLITS = ("train", "val", "test")
LIST_DIRS = ("list", "list/list")
LABEL_PLACES = ("alongside", "nested", "annotations_new")
NATIVE_FOLDERS = {"train": "train", "valid": "val", "test": "test"}
LIST_FORMAT_SIZE = (1640, 590)


@dataclass(frozen=True)
class DatasetFormat:
    """`samples` reads a dataset's images (optionally of some splits, or without some list files), `parse` adds lanes to
    label texts, `lists` names the list files that `samples` reads."""

    samples: Callable[..., DataFrame]
    parse: Callable[[DataFrame, str], DataFrame]
    lists: Callable[[SparkSession, Row, str, Set[str] | None], list[str]] | None = None


def _slashes(*parts: str) -> str:
    return "/".join(p.strip("/") if i else p.rstrip("/") for i, p in enumerate(parts) if p)


def _lines(spark: SparkSession, uri: str) -> DataFrame:
    """Lines of a list file that are not blank, and their place in its order; a long file is split over tasks.

    A file that is no UTF-8 text cannot be read, like one that the store does not give.
    """
    text = spark.read.text(uri)
    sound = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(F.raise_error(F.lit(f"list file is not UTF-8: {uri}")).cast("string"))
    rows = text.withColumn("value", sound).select(
        F.col("_metadata.file_path").alias("part"), F.col("_metadata.file_block_start").alias("start"),
        # Spark has cut the text at line feeds; the other breaks are rare, and to look for one costs less than to split.
        F.explode(F.when(F.col("value").rlike(INNER_BREAK), F.split("value", LINE_BREAK)).otherwise(F.array("value"))).alias("line"),
    )
    placed = rows.select("line", F.struct("part", "start", F.monotonically_increasing_id().alias("row")).alias("place"))
    return placed.filter(F.col("line").rlike(NOT_SPACE))


def _samples(entries: DataFrame, dataset: str, size=(None, None)) -> DataFrame:
    width, height = size
    rel = F.col("rel_path")
    return align(entries.withColumns({
        "dataset": F.lit(dataset), "width": F.lit(width), "height": F.lit(height),
        "image_id": P.image_id(F.lit(dataset), rel), "frame_id": P.frame_id(rel), "sequence_id": P.sequence_id(rel),
    }), SAMPLES)


def _all(spark: SparkSession, frames: list[DataFrame]) -> DataFrame:
    out = spark.createDataFrame([], SAMPLES)
    for frame in frames:
        out = out.unionByName(frame)
    return out


def list_files(spark: SparkSession, root: str, list_dir: str | None) -> list[Row]:
    """(path, split, of_category) of the list files in use, in reading order; a dataset has a handful.

    The folder is the named one, else the first of `LIST_DIRS` with a train list or anything below `test_split`.
    Category lists stand for the test split; a plain test list counts only where there are none.
    """
    folders = [list_dir.strip("/")] if list_dir else list(LIST_DIRS)
    below = P.below("path", root)
    # A list is one file or a folder of parts.
    listed = list_objects(spark, f"{_slashes(root, list_dir or LIST_DIRS[0])}/").select(
        below.alias("object"), F.regexp_replace(below, r"\.txt/[^/]*$", ".txt").alias("path")
    )
    placed = listed.withColumn("folder", F.explode(F.array(*[F.lit(f) for f in folders]))).withColumns({
        "rank": F.array_position(F.array(*[F.lit(f) for f in folders]), F.col("folder")),
        "order": F.array_position(F.array(*[F.lit(f"{s}.txt") for s in SPLITS]), F.expr("substr(path, length(folder) + 2)")),
        "in_categories": F.startswith("object", F.concat("folder", F.lit("/test_split"))),
    }).filter(F.startswith("object", F.concat("folder", F.lit("/"))) & ((F.col("order") > 0) | F.col("in_categories")))
    names = placed.groupBy("rank", "order", "in_categories", "path").agg(F.lit(1).alias("_"))
    per_folder = names.groupBy("rank").agg(
        F.bool_or((F.col("order") == 1) | F.col("in_categories")).alias("usable"),
        F.bool_or(F.col("in_categories") & F.endswith("path", F.lit(".txt"))).alias("has_categories"),
    )
    # Folders without a sign of lists come last; the first of them is still read.
    chosen = per_folder.orderBy(F.desc("usable"), "rank").limit(1).filter(F.col("usable") | (F.col("rank") == 1))
    files = names.join(chosen, "rank").filter(
        F.when(F.col("in_categories"), F.endswith("path", F.lit(".txt"))).otherwise((F.col("order") < len(SPLITS)) | ~F.col("has_categories"))
    )
    split = F.when(F.col("in_categories"), SPLITS[-1]).otherwise(F.get(F.array(*[F.lit(s) for s in SPLITS]), F.col("order").cast("int") - 1))
    return files.select("path", split.alias("split"), F.col("in_categories").alias("of_category")).orderBy("in_categories", "order", "path").collect()


def first_entry(spark: SparkSession, uris: list[str]) -> DataFrame:
    """One row: the first image path of the lists, in their order; null if they name none."""
    numbered = [_lines(spark, uri).select("line", F.lit(i).alias("list"), "place") for i, uri in enumerate(uris)]
    lines = reduce(DataFrame.unionByName, numbered)
    first = lines.agg(F.min_by("line", F.struct("list", "place")).alias("line"))
    return first.select(P.list_entry("line").alias("rel_path"))


def list_places(entry: DataFrame, base: Column) -> Row:
    """Ranks (from 0) of the image place and of the label place where an entry's objects are found, null if nowhere.

    Images lie below the root or once more below their driver; labels in one of `LABEL_PLACES`.
    """
    images = [P.native_image_uri(base, "rel_path", F.lit(nested)) for nested in (False, True)]
    labels = [P.native_label_uri(base, "rel_path", F.lit(place)) for place in LABEL_PLACES]
    candidates = entry.filter("rel_path IS NOT NULL").select(F.posexplode(F.array(*images, *labels)).alias("rank", "uri"))
    rank = F.when(F.col("found"), F.col("rank"))
    is_image = F.col("rank") < len(images)
    return with_presence(candidates, "uri").agg(
        F.min(F.when(is_image, rank)).alias("image"), F.min(F.when(~is_image, rank - len(images))).alias("label")
    ).first()


def unreadable(spark: SparkSession, uris: list[str]) -> dict[str, str]:
    """The list files that cannot be read to their end, each with its error; a dataset has a handful."""
    found = {}
    for uri in uris:
        try:
            _lines(spark, uri).agg(F.count("line")).first()
        except Exception as error:  # noqa: BLE001 - becomes part of the run's record
            found[uri] = problem(error).splitlines()[0]
    return found


def list_names(spark: SparkSession, descriptor: Row, root: str, splits: Set[str] | None = None) -> list[str]:
    return [_slashes(root, f.path) for f in list_files(spark, root, descriptor.list_dir)]


def list_samples(spark: SparkSession, descriptor: Row, root: str, splits: Set[str] | None = None, without: Set[str] = frozenset()) -> DataFrame:
    """Images named by list files: the first column of every line. Where images and labels lie is judged by the first."""
    files, base = [f for f in list_files(spark, root, descriptor.list_dir) if _slashes(root, f.path) not in without], F.lit(root)
    if not files:
        return _all(spark, [])
    places = list_places(first_entry(spark, [_slashes(root, f.path) for f in files]), base)
    label_place = descriptor.label_dir or LABEL_PLACES[places.label or 0]
    frames = []
    for file in files:
        if splits is not None and file.split not in splits:
            continue
        category = P.category_name(F.lit(file.path)) if file.of_category else F.lit(None)
        entries = _lines(spark, _slashes(root, file.path)).select(
            P.list_entry("line").alias("rel_path"), F.lit(file.split).alias("split"), category.alias("category")
        )
        frames.append(_samples(entries.withColumns({
            "src_image_uri": P.native_image_uri(base, "rel_path", F.lit(places.image == 1)),
            "label_uri": P.native_label_uri(base, "rel_path", F.lit(label_place)),
        }), descriptor.dataset or descriptor.adapter, LIST_FORMAT_SIZE))
    return _all(spark, frames)


def json_names(spark: SparkSession, descriptor: Row, root: str, splits: Set[str] | None = None) -> list[str]:
    store = Store()
    named = [_slashes(root, f, f"{f}.txt") for f, s in NATIVE_FOLDERS.items() if splits is None or s in splits]
    return [uri for uri in named if store.has_text(uri)]


def json_samples(spark: SparkSession, descriptor: Row, root: str, splits: Set[str] | None = None, without: Set[str] = frozenset()) -> DataFrame:
    """Images of split folders: named whole-line by `<folder>.txt`, or listed where there is no such file
    and images without labels are wanted."""
    wanted = {f: s for f, s in NATIVE_FOLDERS.items() if splits is None or s in splits}
    question = small_frame(spark, [(f, _slashes(root, f, f"{f}.txt")) for f in wanted], "folder string, uri string")

    def probe(batches):
        store = Store()
        for pdf in batches:
            yield pdf.assign(found=[store.has_text(u) for u in pdf.uri])

    frames = []
    for folder, uri, found in question.mapInPandas(probe, "folder string, uri string, found boolean").collect():
        base = _slashes(root, folder)
        if uri in without:
            continue
        if found:
            entry = F.regexp_replace(stripped(F.col("line")), "^/+", "")
            native = _lines(spark, uri).select(entry.alias("native"))
        elif descriptor.ingest_unlabeled:
            files = list_objects(spark, f"{base}/images").filter(F.endswith("path", F.lit(descriptor.image_ext)))
            native = files.select(P.below("path", base).alias("native"))
        else:
            continue
        frames.append(_samples(native.select(
            P.without_image_dir("native").alias("rel_path"), F.lit(wanted[folder]).alias("split"),
            P.join_path(F.lit(base), "native").alias("src_image_uri"),
            P.join_path(F.lit(base), P.json_label_path("native")).alias("label_uri"),
        ), descriptor.dataset or descriptor.adapter))
    return _all(spark, frames)


# The names descriptors use for the formats.
FORMATS: dict[str, DatasetFormat] = {
    "culane": DatasetFormat(list_samples, LN.parse_text_lanes, list_names),
    "curvelanes": DatasetFormat(json_samples, LN.parse_json_lanes, json_names),
}


def find_format(name: str, formats: dict[str, DatasetFormat] = FORMATS) -> DatasetFormat:
    if name not in formats:
        raise ValueError(f"unknown adapter {name!r}; known: {', '.join(sorted(formats))}")
    return formats[name]
