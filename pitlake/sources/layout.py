"""Which files of a folder hold its rows, and how a maintained partition is published.

A partition that was compacted, promoted or upserted holds a manifest: a small file
``_published-<n>.json`` that names a data folder and the files that it replaces. Its rows are
those of the data folder and of every file that is not replaced. A manifest is created only
if there is none of its number, as the last step: a reader sees the state before or the state
after, and of two writers one fails. The newest manifest counts. What it replaces is removed
later (:func:`prune`), when no reader uses it any more.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_MANIFEST = re.compile(r"_published-(\d{9})\.json")


class PublishError(RuntimeError):
    """Another writer published first, or files could not be put in place."""


@dataclass(frozen=True)
class Stored:
    """A data file and its size in bytes."""

    path: str
    size: int


class Store:
    """Hadoop's file system of a path."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def children(self, path: str) -> list[tuple[str, bool, int]]:
        """(path, is a folder, size) of what a folder holds."""
        return sorted((s.getPath().toString(), s.isDirectory(), s.getLen()) for s in self._fs.listStatus(self._path(path)))

    def text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str, overwrite: bool = False) -> bool:
        """Write a small file; False if it may not be overwritten and is there."""
        try:
            out = self._fs.create(self._path(path), overwrite)
        except Py4JJavaError:
            if not overwrite and self.exists(path):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def rename(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise PublishError(f"{source} could not be renamed to {target}")

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def _hidden(name: str) -> bool:
    return name.startswith(("_", ".")) or name.endswith(".tmp")


def _own_files(store: Store, listed: list[tuple[str, bool, int]]) -> list[Stored]:
    """The data files of one folder, given what it holds."""
    manifests = sorted(p for p, folder, _ in listed if not folder and _MANIFEST.fullmatch(_name(p)))
    files = [Stored(p, n) for p, folder, n in listed if not folder and not _hidden(_name(p))]
    if not manifests:
        return files
    manifest = json.loads(store.text(manifests[-1]))
    gone = set(manifest["replaced"])
    folder = f"{manifests[-1].rsplit('/', 1)[0]}/{manifest['data']}"
    kept = [f for f in files if _name(f.path) not in gone]
    return kept + [Stored(p, n) for p, inner, n in store.children(folder) if not inner and not _hidden(_name(p))]


def data_files(spark: SparkSession, root: str, first: str | None = None, last: str | None = None) -> list[Stored]:
    """The data files under a folder, those of ``dt=`` folders outside the range left out without listing them."""
    store = Store(spark, root)
    if not store.exists(root):
        return []
    out, open_ = [], [root]
    while open_:
        listed = store.children(open_.pop())
        out += _own_files(store, listed)
        for path, folder, _ in listed:
            name = _name(path)
            if folder and not _hidden(name):
                day = name[3:] if name.startswith("dt=") else None
                if day is None or ((first is None or day >= first) and (last is None or day <= last)):
                    open_.append(path)
    return sorted(out, key=lambda f: f.path)


def publish(df: DataFrame, path: str, replaced: list[Stored]) -> str:
    """Write rows that take the place of some files of a partition; the path of the new data.

    The rows are written into a folder of their own first, under a name that nobody else
    uses; the manifest that makes them the partition's comes last.
    """
    spark = df.sparkSession
    store = Store(spark, path)
    listed = store.children(path) if store.exists(path) else []
    numbers = [int(_MANIFEST.fullmatch(_name(p))[1]) for p, folder, _ in listed if not folder and _MANIFEST.fullmatch(_name(p))]
    before = json.loads(store.text(f"{path}/_published-{max(numbers):09d}.json")) if numbers else {"data": None, "replaced": []}
    base = path.rstrip("/").rsplit("/", 1)[-1]
    if strange := [f.path for f in replaced if not re.search(rf"/{re.escape(base)}/(_data-[0-9a-f]+/)?[^/]+$", f.path)]:
        raise PublishError(f"{path} is no single partition: {strange[0]}")
    data = f"_data-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{data}")
    names = {_name(f.path) for f in replaced if "/_data-" not in f.path}  # an older data folder goes with its manifest
    content = {"data": data, "replaced": sorted({*before["replaced"], *names})}
    if not store.create(f"{path}/_published-{max(numbers, default=-1) + 1:09d}.json", json.dumps(content)):
        store.delete(f"{path}/{data}")
        raise PublishError(f"{path}: another writer published first")
    return f"{path}/{data}"


def prune(spark: SparkSession, path: str) -> int:
    """Remove what the newest manifest of a partition replaces, and data of older ones; how many files and folders there were."""
    store = Store(spark, path)
    listed = store.children(path)
    manifests = sorted(p for p, folder, _ in listed if not folder and _MANIFEST.fullmatch(_name(p)))
    if not manifests:
        return 0
    newest = json.loads(store.text(manifests[-1]))
    gone = [p for p, folder, _ in listed if (folder and _name(p).startswith("_data-") and _name(p) != newest["data"]) or (not folder and _name(p) in newest["replaced"])]
    for p in [*gone, *manifests[:-1]]:
        store.delete(p)
    return len(gone)


def data_folder(path: str, files: list[Stored]) -> list[Stored]:
    """Those of a partition's files that lie in its published data folder."""
    return [f for f in files if "/_data-" in f.path]


def folder_files(spark: SparkSession, path: str) -> list[Stored]:
    """The data files of one folder."""
    return [Stored(p, n) for p, folder, n in Store(spark, path).children(path) if not folder and not _hidden(_name(p))]
