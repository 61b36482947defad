"""Streams into catalogue tables: at least once delivery, keyed upsert, so the effect is exactly once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.tables import CatalogueTable
from ..session import stage


def upsert_stream(
    rows: DataFrame, table: CatalogueTable, checkpoint: str, order: Sequence[Column] = (), **trigger
) -> StreamingQuery:
    """Upsert every micro-batch. A batch repeated after a failure, or a replay from the start with a new
    checkpoint, leaves the same table. With an `order`, stored rows are ranked together with the new ones of their
    keys, so a late row does not replace one that comes before it in the order."""

    def work(batch: DataFrame, number: int) -> None:
        # An upsert passes over its rows more than once; the stream's source is read only here.
        rows = stage(batch, "stream-batch")
        if order:
            stored = table.read().join(rows.select(*table.spec.key), list(table.spec.key), "left_semi")
            rows = rows.unionByName(stored.select(*rows.columns))
        table.upsert(rows, order)

    return rows.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def on_schedule(ticks: DataFrame, checkpoint: str, job: Callable[[int], None], **trigger) -> StreamingQuery:
    """Run a batch job for every micro-batch of a stream, for instance a rate stream or an upload folder.

    What is still to be done is found by the job's own anti-join, so an extra run is harmless.
    """

    def work(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            job(number)

    return ticks.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
