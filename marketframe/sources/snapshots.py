"""Snapshot tables, reading side: which stored folders make up a table now.

A snapshot table keeps every partition in one immutable folder ``commit=<name>/key=value/...`` below its root; a numbered file below
``_versions`` lists the folder of each partition. Readers take the highest number, so they see all of a write or nothing of it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

VERSIONS = "_versions"


@dataclass(frozen=True)
class Snapshot:
    """One version: the folder of each partition, by its key values, and the last batch taken from each stream."""

    version: int = 0
    folders: dict[tuple[str | None, ...], str] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        entries = [[list(keys), folder] for keys, folder in self.folders.items()]
        return json.dumps({"partitions": entries, "streams": self.streams})

    @staticmethod
    def from_json(version: int, text: str) -> Snapshot:
        read = json.loads(text)
        return Snapshot(version, {tuple(keys): folder for keys, folder in read["partitions"]}, read["streams"])


def hadoop_path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of a path, and the path on it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def any_file(spark: SparkSession, root: str) -> bool:
    """Whether a data file lies below ``root``, which need not exist; the listing stops at the first. Names that begin with ``_`` or ``.`` are no data."""
    system, place = hadoop_path(spark, root)
    if not system.exists(place):
        return False
    above = len(system.makeQualified(place).toString().rstrip("/"))
    files = system.listFiles(place, True)
    while files.hasNext():
        parts = files.next().getPath().toString()[above:].split("/")
        if not any(part.startswith(("_", ".")) for part in parts):
            return True
    return False


def folder_names(spark: SparkSession, root: str) -> list[str]:
    """What lies directly below ``root``, without hidden names."""
    system, place = hadoop_path(spark, root)
    names = [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []
    return [n for n in names if not n.startswith(("_", "."))]


def current(spark: SparkSession, root: str) -> Snapshot | None:
    """The newest version of the snapshot table at ``root``, or None if there is no such table."""
    system, place = hadoop_path(spark, f"{root}/{VERSIONS}")
    if not system.exists(place):
        return None
    names = [s.getPath().getName() for s in system.listStatus(place)]
    numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith((".", "_"))]
    return load_version(spark, root, max(numbers)) if numbers else None


def load_version(spark: SparkSession, root: str, version: int) -> Snapshot:
    system, place = hadoop_path(spark, version_path(root, version))
    stream = system.open(place)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Snapshot.from_json(version, text)


def version_path(root: str, version: int) -> str:
    return f"{root}/{VERSIONS}/{version:012d}.json"
