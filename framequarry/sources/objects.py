"""Object scans: listing a tree, and reading objects named by a column."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.paths import is_user_image
from ..session import stage
from .listing import Objects
from .requests import Requests
from .store import THREADS, Store, extended, pieces, problem

def list_objects(spark: SparkSession, *prefixes: str) -> DataFrame:
    """All objects whose URI starts with one of the prefixes: path, length, modificationTime.

    A prefix is text, not a folder: `x/images` also finds `x/images2/a`. A missing prefix gives no rows. The tree is
    listed once, by a data source that cuts it into folders and shares of large folders, and kept in the shared folder.
    """
    spark.dataSource.register(Objects)
    wanted = str(4 * spark.sparkContext.defaultParallelism)
    return stage(spark.read.format("objects").option("prefixes", json.dumps(prefixes)).option("partitions", wanted).load(), "listing")


def with_presence(df: DataFrame, uri: str) -> DataFrame:
    """Add `found`: whether the object a row names exists. For few rows; many are joined to a listing."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        store = Store()
        for batch in batches:
            yield extended(batch, {"found": pa.array([name is not None and store.exists(name) for name in batch.column(uri).to_pylist()], pa.bool_())})

    return df.mapInArrow(run, T.StructType(df.schema.fields + [T.StructField("found", T.BooleanType())]))


def user_images(objects: DataFrame) -> DataFrame:
    return objects.filter(is_user_image("path"))


def _fetcher(uri: str, as_text: bool, rows: int):
    def fetch(batches: Iterator) -> Iterator:
        import pyarrow as pa

        store = Store()

        def one(name):
            if name is None:
                return None, False, None
            try:
                data = store.read(name)
                if data is None:
                    return None, False, None
                return (data.decode("utf-8") if as_text else data), True, None
            except Exception as error:  # noqa: BLE001 - becomes the row's error
                return None, False, problem(error)

        with Requests() as requests:
            for batch in batches:
                for part in pieces(batch, rows):
                    got = requests.map(one, part.column(uri).to_pylist())
                    yield extended(part, {
                        "content": pa.array([g[0] for g in got], pa.string() if as_text else pa.binary()),
                        "found": pa.array([g[1] for g in got], pa.bool_()),
                        "read_error": pa.array([g[2] for g in got], pa.string()),
                    })

    return fetch


def read_objects(df: DataFrame, uri: str, as_text: bool = False) -> DataFrame:
    """Add `content`, `found` and `read_error` of the object each row names.

    One read is also the existence test: a missing object (or a NULL name) is not found and no error, an
    empty one is found with empty content. File sources would drop empty files and index every path on
    the driver.
    """
    kind = T.StringType() if as_text else T.BinaryType()
    schema = T.StructType(df.schema.fields + [
        T.StructField("content", kind), T.StructField("found", T.BooleanType()), T.StructField("read_error", T.StringType()),
    ])
    return df.mapInArrow(_fetcher(uri, as_text, 256 if as_text else THREADS), schema)


def with_existence(df: DataFrame, uri: str, objects: DataFrame, flag: str) -> DataFrame:
    """Add whether the object a row names is in a listing."""
    known = objects.select(F.col("path").alias(uri), F.lit(True).alias("_there"))
    return df.join(known, uri, "left").withColumn(flag, F.coalesce("_there", F.lit(False))).drop("_there")
