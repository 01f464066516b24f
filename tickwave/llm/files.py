"""Writing binary files from tasks into the shared folder, and reading them back.

Spark has no writer for arbitrary bytes, so tasks stream files through
``pyarrow.fs`` to the folder that ``spark.checkpoint.dir`` names (any store that
pyarrow reaches by URI).  A task writes under names of its own attempt and
returns them as rows; those rows are stored as a manifest table.  Only files of
successful attempts are in the manifest, so a lost executor's half-written
files are never read and its task simply runs again.
"""

from __future__ import annotations

import posixpath
import uuid

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession

from tickwave.session import scratch_path

#: A task starts a new file beyond this size.
FILE_BYTES = 128 << 20


def output_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint directory, as a URI."""
    path = scratch_path(spark, name)
    return path if "://" in path or path.startswith("file:") else "file://" + path


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


class Roller:
    """Consecutive files of one task attempt: part-<partition>-<number>.<suffix>."""

    def __init__(self, folder: str, suffix: str, limit: int = FILE_BYTES):
        self.store, root = open_store(folder)
        context = TaskContext.get()
        self.part = context.partitionId() if context else 0
        self.uri = posixpath.join(folder, uuid.uuid4().hex)
        self.path = posixpath.join(root, self.uri.rsplit("/", 1)[1])
        self.store.create_dir(self.path, recursive=True)
        self.suffix, self.limit = suffix, limit
        self.number, self.out, self.at = -1, None, 0

    def full(self) -> bool:
        return self.out is None or self.at >= self.limit

    def begin(self) -> str:
        """Open the next file; returns its base name."""
        self.close()
        self.number += 1
        self.at = 0
        self.name = f"part-{self.part:05d}-{self.number:03d}.{self.suffix}"
        self.out = self.store.open_output_stream(posixpath.join(self.path, self.name))
        return self.name

    def file(self) -> str:
        return posixpath.join(self.uri, self.name)

    def write(self, data: bytes) -> int:
        """Append; returns the offset at which the data begin."""
        at = self.at
        self.out.write(data)
        self.at += len(data)
        return at

    def beside(self, suffix: str, data: bytes) -> None:
        """A companion file of the present one."""
        with self.store.open_output_stream(posixpath.join(self.path, self.name + suffix)) as f:
            f.write(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def open_input(uri: str):
    store, path = open_store(uri)
    return store.open_input_stream(path)


def open_random(uri: str):
    store, path = open_store(uri)
    return store.open_input_file(path)


def discard(df) -> None:
    """Delete a stored intermediate table that nothing reads any more."""
    found = df.inputFiles()
    if found:
        store, path = open_store(posixpath.dirname(found[0]))
        store.delete_dir(path)
