"""Object listing as a Spark data source: `spark.read.format("objects").option("prefixes", ...)`.

A prefix is cut into partitions before anything is read whole: a folder with few entries gives its subfolders, a flat
folder with many is cut into shares by a checksum of the names. Each partition then goes down its part of the tree entry by
entry, so no task and no driver ever holds a listing.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .store import Store

#: Entries of a folder that are looked at before it is cut, and shares that a folder with more is cut into.
LOOKED_AT, SHARES = 2000, 16
#: Rows handed to Spark at a time.
_BATCH = 5000


@dataclass
class Part(InputPartition):
    """A share of the entries of a folder whose names start with `prefix`, and all that is below them if `deep`."""

    folder: str
    prefix: str = ""
    share: int = 0
    shares: int = 1
    deep: bool = True


def cut(store: Store, part: Part) -> tuple[list[Part], list[Part]]:
    """A folder's parts, and its subfolders where it has few entries; no more entries than are looked at are held."""
    found = list(islice(store.entries(part.folder, part.prefix), LOOKED_AT + 1))
    if len(found) <= LOOKED_AT:
        below = [Part(uri) for uri, is_folder, *_ in sorted(found) if is_folder]
        return [Part(part.folder, part.prefix, deep=False)] if len(below) < len(found) else [], below
    return [Part(part.folder, part.prefix, share, SHARES) for share in range(SHARES)], []


class ObjectsReader(DataSourceReader):
    def __init__(self, prefixes: list[str], wanted: int):
        self.prefixes, self.wanted = prefixes, wanted

    def partitions(self) -> list[Part]:
        """About as many parts as wanted: folders are cut from the top down until there are."""
        store, parts = Store(), []
        folders = deque(Part(*prefix.rpartition("/")[::2]) for prefix in self.prefixes)
        while folders and len(parts) + len(folders) < self.wanted:
            own, below = cut(store, folders.popleft())
            parts += own
            folders += below
        return [*parts, *folders] or [Part("", deep=False)]

    def read(self, part: Part) -> Iterator:
        import pyarrow as pa

        store, rows = Store(), []

        def batch():
            columns = zip(*rows) if rows else ((), (), ())
            kinds = (pa.string(), pa.int64(), pa.timestamp("us", tz="UTC"))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "length", "modificationTime"])

        if not part.folder:
            return
        # One open folder per level of the tree; a folder's own entries come one by one.
        levels = [store.entries(part.folder, part.prefix, part.share, part.shares)]
        while levels:
            for uri, is_folder, length, modified in levels[-1]:
                if not is_folder:
                    rows.append((uri, length, modified))
                    if len(rows) == _BATCH:
                        yield batch()
                        rows.clear()
                elif part.deep:
                    levels.append(store.entries(uri))
                    break
            else:
                levels.pop()
        if rows:
            yield batch()


class Objects(DataSource):
    """Options: `prefixes`, a JSON list of URI prefixes, and `partitions`, how many parts are wanted."""

    @classmethod
    def name(cls) -> str:
        return "objects"

    def schema(self) -> str:
        return "path string, length long, modificationTime timestamp"

    def reader(self, schema) -> ObjectsReader:
        return ObjectsReader(json.loads(self.options["prefixes"]), int(self.options.get("partitions", "64")))
