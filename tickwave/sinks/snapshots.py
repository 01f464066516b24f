"""Snapshots of a venue's candles: a refresh is seen whole or not at all.

A refresh writes a folder of its own,

    root/exchange=<venue>/snapshot=<id>/year=<YYYY>/month=<MM>/part=<n>/

and then adds ``root/exchange=<venue>/_commits/<number>.json``, which names the
folder and what it holds.  Readers take the folder of the highest commit, so a
refresh that fails half way leaves the rows that were there, and a reader that
has begun keeps its folder while a newer one is added.  A commit file is created
only if its number is free: of two refreshes that end together the second
fails and says so.  Commits and folders are handled by Spark's own file-system
client, so any store that the tables can be on will do.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

COMMITS = "_commits"
#: Snapshots that readers may still be on: the newest ones, at least this many.
KEEP = 2
#: Folders without a commit (of failed refreshes) are removed after this time.
ORPHAN_SECONDS = 24 * 3600


@dataclass
class Commit:
    """What one refresh left: its folder, months as "YYYY-MM", and figures of the run."""

    number: int
    snapshot: str
    months: list[str]
    files: int
    figures: dict = field(default_factory=dict)


class Folder:
    """A folder on any store that Spark can read."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path
        self.fs = self._path().getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str = ""):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self.fs.exists(self._path(name))

    def entries(self, name: str = "") -> list[tuple[str, bool, float]]:
        """(name, is a folder, seconds since the epoch) of what lies directly in it."""
        if not self.exists(name):
            return []
        return [(s.getPath().getName(), s.isDirectory(), s.getModificationTime() / 1000) for s in self.fs.listStatus(self._path(name))]

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """A new file; one of that name must not be there."""
        out = self.fs.create(self._path(name), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def remove(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


def venue_root(root: str, venue: str) -> str:
    return f"{root}/exchange={venue}"


def commits(spark: SparkSession, root: str, venue: str) -> list[Commit]:
    """The venue's commits, oldest first.  A file that is still being written
    doesn't parse and isn't one yet."""
    folder = Folder(spark, venue_root(root, venue))
    out = []
    for name, _, _ in sorted(folder.entries(COMMITS)):
        if name.endswith(".json") and not name.startswith((".", "_")):
            try:
                out.append(Commit(**json.loads(folder.read(f"{COMMITS}/{name}"))))
            except (ValueError, TypeError):
                continue
    return out


def new_snapshot() -> str:
    return f"{int(time.time())}-{uuid.uuid4().hex[:8]}"


def snapshot_path(root: str, venue: str, snapshot: str) -> str:
    return f"{venue_root(root, venue)}/snapshot={snapshot}"


def commit(spark: SparkSession, root: str, venue: str, snapshot: str, figures: dict | None = None, after: int | None = None) -> Commit:
    """Makes a written snapshot the venue's current one.  ``after`` is the number
    of the commit that the refresh began from; if another one was added since,
    the snapshot isn't committed."""
    folder = Folder(spark, venue_root(root, venue))
    months, files = [], 0
    for year, is_year, _ in sorted(folder.entries(f"snapshot={snapshot}")):
        if is_year and year.startswith("year="):
            for month, is_month, _ in sorted(folder.entries(f"snapshot={snapshot}/{year}")):
                if is_month:
                    months.append(f"{year[5:]}-{month[6:]}")
                    for part, is_part, _ in folder.entries(f"snapshot={snapshot}/{year}/{month}"):
                        files += sum(n.endswith(".parquet") for n, _, _ in folder.entries(f"snapshot={snapshot}/{year}/{month}/{part}")) if is_part else 0
    before = commits(spark, root, venue)
    now = before[-1].number if before else 0
    if after is not None and now != after:
        raise RuntimeError(f"{venue}: another refresh was committed meanwhile ({now}, begun from {after})")
    done = Commit(now + 1, snapshot, months, files, figures or {})
    folder.create(f"{COMMITS}/{done.number:08d}.json", json.dumps(asdict(done)))
    return done


def current(spark: SparkSession, root: str, venue: str) -> Commit | None:
    found = commits(spark, root, venue)
    return found[-1] if found else None


def expire(spark: SparkSession, root: str, venue: str, keep: int = KEEP, orphan_seconds: float = ORPHAN_SECONDS) -> list[str]:
    """Removes all but the ``keep`` newest committed snapshots, and folders of
    refreshes that never ended; returns the removed snapshots."""
    folder = Folder(spark, venue_root(root, venue))
    have = commits(spark, root, venue)
    kept = {c.snapshot for c in have[-keep:]}
    old = {c.snapshot for c in have} - kept
    gone = []
    for name, is_folder, changed in folder.entries():
        snapshot = name.removeprefix("snapshot=")
        if is_folder and snapshot != name and snapshot not in kept and (snapshot in old or changed < time.time() - orphan_seconds):
            folder.remove(name)
            gone.append(snapshot)
    for c in have[:-keep]:
        folder.remove(f"{COMMITS}/{c.number:08d}.json")
    return gone


def venues(spark: SparkSession, root: str) -> list[str]:
    return sorted(n.removeprefix("exchange=") for n, is_folder, _ in Folder(spark, root).entries() if is_folder and n.startswith("exchange="))
