"""Versions of a zone: tables are written beside those in use, and one small file publishes them together.

A zone is a folder. Its tables lie in new folders below ``data``, one for each commit; the files of
``_versions`` say which folder each table, or each partition of one, is read from. The file with the
greatest number counts. It is created, never changed, so a reader sees all of a commit or nothing of it,
and a run that fails leaves what was there. A folder without such files is read as it lies.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: The newest version and those before it that running readers may still use.
KEPT = 2
#: A folder that no version names goes after so many seconds: its run has failed without a trace.
ORPHAN_SECONDS = 7 * 24 * 3600
#: Key of a table without partitions.
WHOLE = ""


class ConflictError(RuntimeError):
    """Another run has published in the meantime."""


@dataclass
class Version:
    """What is published: the folder of each partition of each table, and the writer's own notes."""

    number: int = 0
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


@dataclass
class Draft(Version):
    """The next version while it is made, from the one in use; new tables go below ``folder``."""

    folder: str = ""


class Files:
    """The few calls on a file system that Spark itself does not offer, in whatever store a path lies."""

    def __init__(self, spark: SparkSession, root: str):
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.system = self.path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.root = root

    def _at(self, name: str):
        return self.path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return self.system.exists(self._at(name))

    def list(self, name: str = "") -> list[tuple[str, int, float]]:
        """(name, bytes, seconds since the epoch) of what a folder holds; nothing if there is none."""
        if not self.exists(name):
            return []
        return [(s.getPath().getName(), s.getLen(), s.getModificationTime() / 1000) for s in self.system.listStatus(self._at(name))]

    def read(self, name: str) -> str:
        stream = self.system.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a file that is not there yet; ``FileExistsError`` if it is."""
        try:
            stream = self.system.create(self._at(name), False)
        except Py4JJavaError as error:
            if self.exists(name):
                raise FileExistsError(name) from error
            raise
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.system.delete(self._at(name), True)


def latest(spark: SparkSession, root: str) -> Version | None:
    """The version in use, None for a folder without one. A file that was not written to its end does
    not count."""
    files = Files(spark, root)
    for name in sorted((n for n, _, _ in files.list("_versions") if n.endswith(".json")), reverse=True):
        try:
            found = json.loads(files.read(f"_versions/{name}"))
        except (ValueError, FileNotFoundError):
            continue
        return Version(int(name.removesuffix(".json")), found["tables"], found["notes"])
    return None


@contextmanager
def commit(spark: SparkSession, root: str) -> Iterator[Draft]:
    """Write tables below ``draft.folder``, enter them in ``draft.tables``; all are published at the end.

    If the block fails nothing is published and its folder is removed. ``ConflictError`` if another run
    has published since the block began, as this one started from an older state. On a store without an
    exclusive create the check is no more than that: let one run at a time write a zone.
    """
    base = latest(spark, root) or Version()
    files = Files(spark, root)
    draft = Draft(base.number, {t: dict(p) for t, p in base.tables.items()}, dict(base.notes), f"data/{uuid.uuid4()}")
    try:
        yield draft
        _publish(files, draft)
    except BaseException:
        files.delete(draft.folder)
        raise
    clean(spark, root)


def _publish(files: Files, draft: Draft) -> None:
    text = json.dumps({"tables": draft.tables, "notes": draft.notes}, indent=0)
    taken = {int(n.removesuffix(".json")): at for n, _, at in files.list("_versions") if n.endswith(".json")}
    number = draft.number + 1
    while number in taken:
        # A file that has stayed unfinished for a while is what a dead run has left behind.
        if time.time() - taken[number] < 3600 or _is_whole(files, number):
            raise ConflictError(f"version {number} of {files.root} is there already")
        number += 1
    try:
        files.create(f"_versions/{number:012d}.json", text)
    except FileExistsError as error:
        raise ConflictError(f"version {number} of {files.root} is there already") from error


def _is_whole(files: Files, number: int) -> bool:
    try:
        json.loads(files.read(f"_versions/{number:012d}.json"))
    except ValueError:
        return False
    return True


def clean(spark: SparkSession, root: str, kept: int = KEPT) -> None:
    """Remove versions older than the newest ``kept`` and the folders that only those name."""
    files = Files(spark, root)
    names = sorted(n for n, _, _ in files.list("_versions") if n.endswith(".json"))
    old, live = names[:-kept], names[-kept:]

    def folders(versions: list[str]) -> set[str]:
        found = set()
        for name in versions:
            try:
                tables = json.loads(files.read(f"_versions/{name}"))["tables"]
            except ValueError:
                continue
            found |= {place.split("/")[1] for parts in tables.values() for place in parts.values() if place.startswith("data/")}
        return found

    used = folders(live)
    gone = folders(old) - used
    for name, _, changed in files.list("data"):
        if name in gone or (name not in used and time.time() - changed > ORPHAN_SECONDS):
            files.delete(f"data/{name}")
    for name in old:
        files.delete(f"_versions/{name}")


def partitions(spark: SparkSession, root: str, folder: str) -> list[str]:
    """The ``column=value`` folders of a written table."""
    return [name for name, _, _ in Files(spark, root).list(folder) if "=" in name]


def places(spark: SparkSession, root: str, table: str) -> dict[str, list[str]] | None:
    """The table's folders and the partitions to read of each; None if no version has the table."""
    version = latest(spark, root)
    if version is None or table not in version.tables:
        return None
    found: dict[str, list[str]] = {}
    for part, folder in version.tables[table].items():
        found.setdefault(f"{root}/{folder}" if folder else root, []).append(part)
    return found
