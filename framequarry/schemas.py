"""Declared schemas of the catalogue tables and of the frames that flow between operators."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

STRING, LONG, DOUBLE, TIME = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampType()


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


@dataclass(frozen=True)
class TableSpec:
    """A table: its schema, its key, the columns its files are sorted by (for scan pruning), and its partitions.

    A table is partitioned by the date of the time column `dated_by`, or else by `groups` hash groups of the key. The
    number of groups holds for the life of the table.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    cluster: tuple[str, ...] = field(default=())
    dated_by: str | None = None
    groups: int = 16

    @property
    def partition(self) -> tuple[str, T.DataType]:
        """Name and type of the partition column, for instance `processed_date` of a table dated by `processed_at`."""
        return (f"{self.dated_by.removesuffix('_at')}_date", T.DateType()) if self.dated_by else ("key_group", T.IntegerType())

    def partition_value(self) -> Column:
        if self.dated_by:
            return F.to_date(self.dated_by)
        # Rows with an incomplete key never match, so they may go anywhere: spread them by content.
        spread = F.when(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.key]), F.xxhash64(*self.key))
        return F.pmod(F.coalesce(spread, F.xxhash64(*self.schema.names)), F.lit(self.groups)).cast("int")


IMAGES = TableSpec(
    "images",
    _struct(
        ("image_id", STRING), ("source", STRING), ("dataset", STRING), ("gcs_uri", STRING),
        ("width", LONG), ("height", LONG), ("frame_id", STRING), ("sequence_id", STRING),
        ("user_id", STRING), ("captured_at", TIME), ("ingested_at", TIME), ("split", STRING),
    ),
    ("image_id",),
    ("source", "dataset", "user_id"),
    dated_by="ingested_at",
)

SOURCE_DATASETS = TableSpec(
    "source_datasets",
    _struct(
        ("dataset", STRING), ("version", STRING), ("license", STRING), ("num_images", LONG),
        ("gcs_prefix", STRING), ("normalized_at", TIME), ("notes", STRING),
    ),
    ("dataset", "version"),
    groups=1,
)

USER_IMAGES_PRIVACY = TableSpec(
    "user_images_privacy",
    _struct(
        ("image_id", STRING), ("raw_gcs_uri", STRING), ("clean_gcs_uri", STRING),
        ("faces_blurred", LONG), ("plates_blurred", LONG), ("processed_at", TIME),
        ("model_version", STRING),
    ),
    ("image_id",),
    ("processed_at",),
    dated_by="processed_at",
)

CLASSIFICATIONS = TableSpec(
    "classifications",
    _struct(
        ("image_id", STRING), ("weather", STRING), ("scene", STRING), ("timeofday", STRING),
        ("road_geometry", STRING), ("model", STRING), ("scores", STRING),
        ("classified_at", TIME), ("geometry_at", TIME),
    ),
    ("image_id",),
    ("road_geometry", "weather"),
    dated_by="classified_at",
)

LABEL_REVIEW_STATUS = TableSpec(
    "label_review_status",
    _struct(
        ("image_id", STRING), ("lines_gcs_uri", STRING), ("status", STRING), ("confidence", DOUBLE),
        ("num_lines", LONG), ("created_at", TIME), ("reviewed_at", TIME), ("reviewer", STRING),
    ),
    ("image_id",),
    ("status",),
    dated_by="created_at",
)

USER_IDENTITY = TableSpec(
    "user_identity",
    _struct(("user_id", STRING), ("real_ref", STRING), ("created_at", TIME), ("revoked_at", TIME)),
    ("user_id",),
)

POINT = _struct(("x", DOUBLE), ("y", DOUBLE))
LANES = T.ArrayType(T.ArrayType(POINT))
BOX = _struct(("x1", DOUBLE), ("y1", DOUBLE), ("x2", DOUBLE), ("y2", DOUBLE))

OBJECTS = _struct(("path", STRING), ("length", LONG), ("modificationTime", TIME))

SAMPLES = _struct(
    ("dataset", STRING), ("split", STRING), ("rel_path", STRING), ("src_image_uri", STRING),
    ("category", STRING), ("width", LONG), ("height", LONG), ("label_uri", STRING),
    ("image_id", STRING), ("frame_id", STRING), ("sequence_id", STRING),
)

RUN_LOG = _struct(
    ("run_id", STRING), ("job", STRING), ("dataset", STRING), ("outcome", STRING), ("error", STRING),
    ("counts", T.MapType(STRING, LONG)), ("at", TIME),
)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Shape `df` to `schema`: columns in its order and types, absent ones NULL, extra ones dropped."""
    present = set(df.columns)

    def column(f: T.StructField) -> Column:
        value = F.col(f"`{f.name}`") if f.name in present else F.lit(None)
        return value.cast(f.dataType.simpleString()).alias(f.name)

    return df.select([column(f) for f in schema.fields])
