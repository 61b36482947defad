"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import math
import re
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "framequarry", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the engine relies on; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.variant.allowDuplicateKeys": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Every timestamp in the data model is UTC, so the session must be too; of a JSON object's repeated keys the last counts."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """New folder path in storage that all executors share, removed when the application ends.

    The folder is the one the cluster names in `spark.checkpoint.dir`; a cluster that names none is refused. Only
    a session on one machine (`local[...]`) may leave it unset, and then uses its warehouse folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


# Paths of the tables staged by this thread since it entered `staged_within`.
_STAGED = threading.local()


@contextmanager
def staged_within(spark: SparkSession) -> Iterator[None]:
    """What this thread stages inside is removed at the end, for work of which only counts and its own outputs are kept.

    A stream stages tables run after run, which else would all stand until the application ends, and after it.
    """
    outer, _STAGED.paths = getattr(_STAGED, "paths", None), []
    try:
        yield
    finally:
        paths, _STAGED.paths = _STAGED.paths, outer
        for path in paths:
            with suppress(Py4JError):  # the work is done; what cannot be removed is left
                target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def stage(df: DataFrame, purpose: str, *partition_by: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Used after steps with side effects or a costly model call: later consumers read the staged
    rows, so nothing is run twice and a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    if getattr(_STAGED, "paths", None) is not None:
        _STAGED.paths.append(path)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_frame(spark: SparkSession, rows: list, schema) -> DataFrame:
    """A handful of driver rows as one partition, so a small job is one task."""
    return spark.createDataFrame(rows, schema).coalesce(1)


# Objects a task reads or writes: enough to pay for the task (its Python workers take about 0.1 s each to begin), few
# enough to redo when it is lost.
OBJECTS_PER_TASK = 8192


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Hash `df` by unique keys into tasks sized for object access.

    Rows that name objects are tiny, so partitions sized by bytes would give a task millions of reads.
    The number of tasks follows the number of rows instead: about `OBJECTS_PER_TASK` each, and for small
    inputs a few tasks per core.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(math.ceil(rows / OBJECTS_PER_TASK), min(math.ceil(rows / 64), 2 * cores), 1)
    return df.repartition(tasks, *keys)
