"""Object sinks: writes, copies and removals planned as rows and carried out by the tasks that hold them.

Each adds a `write_error` column. Every one is whole and repeatable, so a retried task does no harm;
stage the result before using it more than once.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F, types as T

from ..sources.requests import Requests
from ..sources.store import THREADS, Store, extended, named_rows, pieces, problem
from .calls import windowed


def _worker(act, rows: int, *columns: str, without: tuple[str, ...] = ()):
    def run(batches: Iterator) -> Iterator:
        from itertools import chain

        import pyarrow as pa

        store, requests = Store(), Requests()

        def one(row):
            try:
                act(store, row)
                return None
            except Exception as error:  # noqa: BLE001 - becomes the row's error
                return problem(error)

        parts = (part for batch in batches for part in pieces(batch, rows))

        def answered():
            for part in parts:
                errors = requests.at_once(one, named_rows(part, *columns))
                yield part.slice(0, len(errors)), errors
                if len(errors) < part.num_rows:
                    yield from windowed(chain([part.slice(len(errors))], parts), None, one, THREADS)

        for part, errors in answered():
            yield extended(part.drop_columns(list(without)) if without else part, {"write_error": pa.array(errors, pa.string())})

    return run


def _carried_out(df: DataFrame, act, rows: int, columns: tuple[str, ...], without: tuple[str, ...] = ()) -> DataFrame:
    """`df` with errors; the columns in `without` end in the task, which would send them back for every row."""
    kept = [f for f in df.schema.fields if f.name not in without]
    return df.mapInArrow(_worker(act, rows, *columns, without=without), T.StructType(kept + [T.StructField("write_error", T.StringType())]))


def write_objects(df: DataFrame, uri: str, data: str, without: tuple[str, ...] = ()) -> DataFrame:
    """Write `data` (text or binary) to the object each row names; a NULL name or NULL data writes nothing.

    Columns that nobody reads afterwards, such as large data, may be named in `without`.
    """

    def act(store, row):
        value = row[data]
        if row[uri] is not None and value is not None:
            store.write(row[uri], value.encode("utf-8") if isinstance(value, str) else value)

    return _carried_out(df, act, 256, (uri, data), without)


def copy_objects(df: DataFrame, source: str, target: str) -> DataFrame:
    """Copy the object in `source` to `target`; a NULL on either side copies nothing.

    Within one store the store itself copies, and no byte comes to the task.
    """

    def act(store, row):
        if row[source] is not None and row[target] is not None:
            store.copy(row[source], row[target])

    return _carried_out(df, act, 256, (source, target))


def remove_objects(df: DataFrame, uri: str) -> DataFrame:
    """Remove the object each row names; a NULL name, or one without an object, removes nothing."""

    def act(store, row):
        if row[uri] is not None:
            store.remove(row[uri])

    return _carried_out(df, act, 256, (uri,))


def place_samples(df: DataFrame, copy: str, source: str, target: str, label_uri: str, label: str) -> DataFrame:
    """Copy the image where `copy` is true, then write its label where there is a text for it; drops both plans."""

    def act(store, row):
        if row[copy]:
            store.copy(row[source], row[target])
        if row[label] is not None:
            store.write(row[label_uri], row[label].encode("utf-8"))

    return _carried_out(df, act, 64, (copy, source, target, label_uri, label), (copy, label))


def label_carry_over(images: DataFrame, objects: DataFrame, raw_lines: str, clean_lines: str) -> DataFrame:
    """Copy plan of the lane files that exist next to raw images: raw and clean URI."""
    there = objects.select(F.col("path").alias(raw_lines))
    return images.select(raw_lines, clean_lines).join(there, raw_lines, "left_semi")
