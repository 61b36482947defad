"""Object access inside tasks: one small helper over pyarrow file systems.

A URI names its store by scheme (`gs://`, `s3://`, `hdfs://`, `file:///`, or a plain local path). These
functions run on executors, per object; partitioning, joining and counting stay with Spark.
"""

from __future__ import annotations

import os
import random
import time
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from datetime import datetime, timezone
from itertools import count
from urllib.parse import urlsplit

# Fixed value: requests in flight per task; object stores answer slowly and in parallel.
THREADS = 16
CHUNK = 8 << 20
# A local file is read in pieces that cost little to set aside.
LOCAL_CHUNK = 1 << 20
# Longest waits, in seconds, before a request that failed is sent again.
WAITS = (0.5, 2, 8)
# Kinds of store that have folders, in which an object can be renamed.
FOLDERS = ("local", "hdfs")
# Errors that another try does not mend.
LASTING = (FileNotFoundError, FileExistsError, PermissionError, IsADirectoryError, NotADirectoryError)


def patiently(request: Callable, waits: tuple = WAITS):
    """What `request` returns; a transient store error is tried again after a random wait, a lasting one is raised."""
    for wait in waits:
        try:
            return request()
        except LASTING:
            raise
        except OSError:
            time.sleep(random.uniform(wait / 4, wait))
    return request()


def in_folder(system, path: str, make: Callable):
    """What `make` returns; only when it finds no folder, that is made first: folders are few, and to ask costs as much as to write."""
    try:
        return make()
    except FileNotFoundError:
        if system.type_name not in FOLDERS:
            raise
        system.create_dir(path.rpartition("/")[0], recursive=True)
        return make()


def _fill(out: int, data: bytes) -> None:
    left = memoryview(data)
    while left:
        left = left[os.write(out, left):]


@contextmanager
def _opened(path: str, flags: int):
    handle = os.open(path, flags, 0o666)
    try:
        yield handle
    finally:
        os.close(handle)


def put_file(system, path: str, data: bytes) -> None:
    """A new object of these bytes. Small local ones are most of a job's requests, and a plain file costs less than a stream."""
    if system.type_name == "local":
        with _opened(path, os.O_WRONLY | os.O_CREAT | os.O_TRUNC) as out:
            _fill(out, data)
    else:
        with system.open_output_stream(path) as out:
            out.write(data)


def copy_file(system, source: str, path: str) -> None:
    """A copy by the store itself; a local one in chunks, like `put_file`."""
    if system.type_name == "local":
        with _opened(source, os.O_RDONLY) as stream, _opened(path, os.O_WRONLY | os.O_CREAT | os.O_TRUNC) as out:
            while chunk := os.read(stream, LOCAL_CHUNK):
                _fill(out, chunk)
    else:
        system.copy_file(source, path)


class Store:
    """File systems by scheme and authority, opened once per task."""

    def __init__(self):
        self._opened = {}
        # Names of unfinished objects: drawn once per store and numbered, as to draw each costs time on every write.
        self._own, self._numbers = uuid.uuid4().hex[:16], count()

    def locate(self, uri: str):
        from pyarrow import fs

        if uri.startswith("/") or uri.startswith("file:"):
            path = "/" + uri.removeprefix("file:").lstrip("/")
            if "file" not in self._opened:
                self._opened["file"] = fs.LocalFileSystem()
            return self._opened["file"], path
        parts = urlsplit(uri)
        key = (parts.scheme, parts.netloc)
        if key not in self._opened:
            self._opened[key] = fs.FileSystem.from_uri(f"{parts.scheme}://{parts.netloc}/")
        system, root = self._opened[key]
        # Object names may hold `?` and `#`, so the name is cut off the URI as text.
        name = uri[len(f"{parts.scheme}://{parts.netloc}"):].lstrip("/")
        return system, f"{root.rstrip('/')}/{name}" if root else name

    def read(self, uri: str) -> bytes | None:
        """Content, or None for an object that does not exist."""
        system, path = self.locate(uri)

        def content():
            with system.open_input_stream(path) as stream:
                return stream.read()

        try:
            return patiently(content)
        except FileNotFoundError:
            return None

    def exists(self, uri: str) -> bool:
        from pyarrow import fs

        system, path = self.locate(uri)
        return system.get_file_info(path).type == fs.FileType.File

    def has_text(self, uri: str) -> bool:
        """A text may be one file or a folder of part files, as Spark writes and reads it."""
        from pyarrow import fs

        system, path = self.locate(uri)
        return system.get_file_info(path).type in (fs.FileType.File, fs.FileType.Directory)

    def entries(self, folder: str, prefix: str = "", share: int = 0, shares: int = 1) -> Iterator[tuple]:
        """(uri, is_folder, length, modified) of a folder's direct entries, one by one, in no order.

        Their names start with `prefix` and fall to the given one of `shares`, by a checksum that deals any names out
        evenly. A missing folder has none. A local folder is read entry by entry, and only the own share is looked at
        closer; other stores answer by folder.
        """
        from pyarrow import fs

        system, path = self.locate(folder)
        base = folder.rstrip("/")

        def wanted(name: str) -> bool:
            return name.startswith(prefix) and (shares == 1 or zlib.crc32(name.encode("utf-8", "surrogateescape")) % shares == share)

        if system.type_name == "local":
            try:
                found = os.scandir(path)
            except (FileNotFoundError, NotADirectoryError):
                return
            with found:
                for entry in found:
                    if wanted(entry.name):
                        with suppress(FileNotFoundError):  # gone since, or a link to nothing
                            state = entry.stat()
                            yield f"{base}/{entry.name}", entry.is_dir(), state.st_size, datetime.fromtimestamp(state.st_mtime, timezone.utc)
        elif system.get_file_info(path).type != fs.FileType.File:
            for entry in system.get_file_info(fs.FileSelector(path, allow_not_found=True, recursive=False)):
                if wanted(entry.base_name):
                    yield f"{base}/{entry.base_name}", entry.type == fs.FileType.Directory, entry.size, entry.mtime

    def write(self, uri: str, data: bytes) -> None:
        def put():
            with self._place(uri) as (system, part):
                in_folder(system, part, lambda: put_file(system, part, data))

        patiently(put)

    def remove(self, uri: str) -> None:
        """One that is gone is no error: a task that is tried again finds what it removed before."""
        system, path = self.locate(uri)
        with suppress(FileNotFoundError):
            patiently(lambda: system.delete_file(path))

    def copy(self, source: str, target: str) -> None:
        """The store's own copy where both objects are in one; else, and where a store has none, in chunks of any size of object."""
        system, path = self.locate(source)

        def within():
            with self._place(target) as (other, part):
                in_folder(other, part, lambda: copy_file(other, path, part))

        def across():
            with system.open_input_stream(path) as stream, self._target(target) as out:
                while chunk := stream.read(CHUNK):
                    out.write(chunk)

        if system.equals(self.locate(target)[0]):
            try:
                return patiently(within)
            except NotImplementedError:
                pass
        patiently(across)

    @contextmanager
    def _target(self, uri: str):
        """Stream to a new object."""
        with self._place(uri) as (system, part), in_folder(system, part, lambda: system.open_output_stream(part)) as out:
            yield out

    @contextmanager
    def _place(self, uri: str):
        """Where to write a new object: a reader sees the old or the whole new content, also after a retry.

        What a failed write leaves is removed, as a cut object would count as present in the next run.
        """
        system, path = self.locate(uri)
        renames = system.type_name in FOLDERS  # object stores show an object once it is whole
        part = f"{path}.{self._own}-{next(self._numbers):x}.part" if renames else path
        try:
            yield system, part
        except BaseException:
            with suppress(OSError):
                system.delete_file(part)
            raise
        if system.type_name == "local":
            os.replace(part, path)
        elif renames:
            system.move(part, path)


def problem(error: BaseException) -> str:
    return f"{type(error).__name__}: {error}"


def extended(batch, columns: dict):
    """Arrow batch with more columns, given as name to array."""
    import pyarrow as pa

    return pa.RecordBatch.from_arrays(
        [*batch.columns, *columns.values()], names=[*batch.schema.names, *columns]
    )


def named_rows(batch, *columns: str) -> list[dict]:
    """Rows of a batch as dictionaries of the columns that are used: the others stay Arrow's."""
    return batch.select(list(dict.fromkeys(columns))).to_pylist()


def pieces(batch, rows: int):
    """A batch in slices of at most `rows`, so that object contents never pile up in a worker."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
