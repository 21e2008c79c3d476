"""Results that are published whole or not at all.

A result is written next to its place, into a folder whose name starts with a point, which readers
of the parent folder do not see. Only when all of it is there, its files are listed in a manifest and
the folder is renamed to its place. A run that ends before that leaves the old result as it was.

An old result is first renamed away and removed at the end, as no file system replaces a folder by
another in one step. A run that ends just between both renames leaves no folder in the place, but
the new one with its manifest beside it: ``settle``, which every next write and ``read_published``
call, finishes the switch, or puts the old result back if the new one is not whole.
Renames are those of Hadoop's file system; on HDFS and local disks each is one step.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from contextlib import ExitStack
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

MANIFEST = "_manifest.json"
NEW, OLD = "new", "old"


class _Folder:
    """A path with its Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self._of = hadoop.fs.Path
        self.path: Any = hadoop.fs.Path(path.rstrip("/"))
        self.fs: Any = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def beside(self, kind: str, name: str) -> Any:
        return self._of(self.path.getParent(), f".{self.path.getName()}.{kind}-{name}")

    def there(self, kind: str) -> list[Any]:
        """Folders that runs have left beside the place, the latest first."""
        parent, start = self.path.getParent(), f".{self.path.getName()}.{kind}-"
        if not self.fs.exists(parent):
            return []
        found = [s for s in self.fs.listStatus(parent) if s.getPath().getName().startswith(start)]
        return [s.getPath() for s in sorted(found, key=lambda s: -s.getModificationTime())]

    def files(self, folder: Any) -> dict[str, int]:
        """Paths below the folder with their sizes, without hidden files and marks."""
        walk, found, base = self.fs.listFiles(folder, True), {}, self.fs.resolvePath(folder).toString()
        while walk.hasNext():
            one = walk.next()
            name = self.fs.resolvePath(one.getPath()).toString().removeprefix(base + "/")
            if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
                found[name] = one.getLen()
        return found

    def note(self, folder: Any, name: str) -> str | None:
        """The text of a small file in the folder, or None where there is none."""
        path = self._of(folder, name)
        if not self.fs.exists(path):
            return None
        size = self.fs.getFileStatus(path).getLen()
        stream = self.fs.open(path)
        try:
            return bytes(stream.readNBytes(size)).decode()
        finally:
            stream.close()

    def put_note(self, folder: Any, name: str, text: str) -> None:
        stream = self.fs.create(self._of(folder, name), True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def manifest(self, folder: Any) -> dict[str, int] | None:
        """What the manifest lists, or None where there is none."""
        text = self.note(folder, MANIFEST)
        return None if text is None else json.loads(text)

    def whole(self, folder: Any) -> bool:
        return (listed := self.manifest(folder)) is not None and listed == self.files(folder)

    def put_manifest(self, folder: Any) -> None:
        self.put_note(folder, MANIFEST, json.dumps(self.files(folder), sort_keys=True))

    def rename(self, source: Any, target: Any) -> None:
        if not self.fs.rename(source, target):
            raise OSError(f"cannot rename {source} to {target}")

    def remove(self, folder: Any) -> None:
        self.fs.delete(folder, True)


def settle(spark: SparkSession, path: str) -> None:
    """Finish, or take back, the switch of a run that ended in the middle; remove what it left.

    For a place that one run writes at a time.
    """
    own = _Folder(spark, path)
    if not own.fs.exists(own.path) and (old := own.there(OLD)):
        new = next((f for f in own.there(NEW) if own.whole(f)), None)
        own.rename(new or old[0], own.path)
    for left in [*own.there(NEW), *own.there(OLD)]:
        own.remove(left)


def publish(spark: SparkSession, write: Callable[[str], None], *paths: str) -> None:
    """Let ``write`` make the same result for each path; then put all in place, none if one fails.

    ``write`` gets a folder to write to. The switches of several paths follow each other when all
    results are there.
    """
    name, ready = uuid.uuid4().hex, []
    with ExitStack() as left:
        for path in paths:
            settle(spark, path)
            own = _Folder(spark, path)
            new = own.beside(NEW, name)
            left.callback(own.remove, new)
            write(new.toString())
            own.put_manifest(new)
            ready.append((own, new))
        for own, new in ready:
            _switch(own, new, own.beside(OLD, name))


def _switch(own: _Folder, new: Any, old: Any) -> None:
    replaced = own.fs.exists(own.path)
    if replaced:
        own.rename(own.path, old)
    try:
        own.rename(new, own.path)
    except Exception:
        if replaced:
            own.rename(old, own.path)
        raise
    if replaced:
        own.remove(old)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The stored Parquet result, after a switch that a run left unfinished has been settled.

    Files that the manifest lists and that are not there, or not as long, are an error.
    """
    settle(spark, path)
    own = _Folder(spark, path)
    if own.fs.exists(own.path) and own.manifest(own.path) is not None and not own.whole(own.path):
        raise OSError(f"{path} does not have the files that its manifest lists")
    return spark.read.parquet(path)


def published_files(spark: SparkSession, path: str) -> DataFrame:
    """``archivo``, ``n_bytes``: the files that the manifest lists; no rows without one."""
    own = _Folder(spark, path)
    listed: Sequence[tuple[str, int]] = sorted((own.manifest(own.path) or {}).items())
    return spark.createDataFrame(list(listed), "archivo string, n_bytes bigint").select(
        "archivo", F.col("n_bytes"))


def remove_others(spark: SparkSession, path: str, keep: str) -> None:
    """Remove all folders below a path but the one named ``keep``."""
    own = _Folder(spark, path)
    for status in own.fs.listStatus(own.path):
        if status.isDirectory() and status.getPath().getName() != keep:
            own.remove(status.getPath())


def write_note(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """A small file beside a result's files; its name should start with ``_``, which readers pass over."""
    own = _Folder(spark, folder)
    own.put_note(own.path, name, text)


def read_note(spark: SparkSession, folder: str, name: str) -> str:
    own = _Folder(spark, folder)
    text = own.note(own.path, name)
    if text is None:
        raise FileNotFoundError(f"{folder} has no {name}")
    return text
