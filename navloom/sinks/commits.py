"""Tables that change by one small step: data goes to a fresh folder, then a marker file makes it current.

A marker is an empty file whose name tells a number, the batch folder it makes current and a tag. Creating
it is one step on every file system, so a reader finds the batch before or the one after, never half of
either, and a job that fails leaves what was current. Markers of a key are only ever added and, two behind
the current one, removed with their data: who resolved a batch just before a commit can read it to its end.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import SparkSession

FOLDER = "_commits"
#: Batches of a key that stay: the current one and the one before, for its readers.
KEPT = 2


class Commit(NamedTuple):
    number: int
    batch: str
    tag: str


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def escaped(spark: SparkSession, key: str) -> str:
    """The key as a name of one folder, as partition folders are named."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(key)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is absent."""
    system, place = _path(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def new_batch() -> str:
    return uuid.uuid4().hex


def history(spark: SparkSession, root: str, key: str) -> list[Commit]:
    """Commits of a key, the current one last."""
    parts = [name.split("-", 2) for name in names_in(spark, f"{root}/{FOLDER}/{escaped(spark, key)}") if name[0] not in "._"]
    return sorted(Commit(int(number), batch, tag) for number, batch, tag in parts)


def current(spark: SparkSession, root: str, key: str) -> Commit | None:
    return next(reversed(history(spark, root, key)), None)


def keys(spark: SparkSession, root: str) -> list[str]:
    """Escaped keys that have a commit."""
    return names_in(spark, f"{root}/{FOLDER}")


def commit(spark: SparkSession, root: str, key: str, batch: str, tag: str = "") -> list[str]:
    """Make a batch current; returns the batches of the key that no reader should still be on, for removal.

    Their markers go first. Of two writers that commit at once the batch of the larger name is current.
    """
    before = history(spark, root, key)
    number = before[-1].number + 1 if before else 1
    folder = f"{root}/{FOLDER}/{escaped(spark, key)}"
    system, marker = _path(spark, f"{folder}/{number:012d}-{batch}-{tag}")
    system.create(marker, False).close()
    old = history(spark, root, key)[:-KEPT]
    for entry in old:
        remove(spark, f"{folder}/{entry.number:012d}-{entry.batch}-{entry.tag}")
    return [entry.batch for entry in old]


def remove(spark: SparkSession, path: str) -> None:
    system, place = _path(spark, path)
    system.delete(place, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, place = _path(spark, path)
    out = system.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _path(spark, path)
    source = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
