"""Snapshot tables, writing side: publish many partitions at once, add to them, or replace parts of them.

A write puts new folders beside the old ones and then adds one version file that names them; whatever stops before that leaves the
table as it was. A version's number is taken by a rename that fails if the file is there, so of two writers that began from the same version the second
is refused. The file system must have such a rename (HDFS and local disks do). Only partitions the new rows touch are read or written.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe import schemas as S
from marketframe.sinks.tables import APPEND, OVERWRITE, SKIP, conform
from marketframe.sources.snapshots import VERSIONS, Snapshot, any_file, current, folder_names, hadoop_path, load_version, version_path
from marketframe.sources.tables import file_inventory, read_folders

Keys = tuple[str | None, ...]
_STATEMENT_PARTITIONS = 200


class ConcurrentWrite(Exception):
    """Another writer published a version in the meantime; nothing of this write is visible."""


def arranged(rows: DataFrame, table: S.Table) -> DataFrame:
    """Rows as a write wants them: whole key ranges per task and, in a clustered table, sorted, so that file statistics serve look-ups.

    A partition far above the advisory size is split over several tasks and files in either case.
    """
    if not table.cluster:
        return rows.hint("rebalance", *table.keys)
    order = [*table.keys, *table.cluster]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def _write_folder(rows: DataFrame, root: str, table: S.Table) -> dict[Keys, str]:
    """Write rows below a new commit folder and say which partitions it holds, from its own listing."""
    spark, name = rows.sparkSession, f"commit={uuid.uuid4().hex}"
    arranged(rows, table).write.partitionBy(*table.keys).option("compression", "snappy").parquet(f"{root}/{name}")
    if not any_file(spark, f"{root}/{name}"):
        return {}
    files = file_inventory(spark, f"{root}/{name}", table.keys)
    folder = F.concat(F.lit(name), F.regexp_extract("path", f"{name}(/.*)/[^/]*$", 1))
    found = files.where(F.array(*table.keys).isNotNull()).select(*table.keys, folder.alias("folder")).distinct().collect()
    return {tuple(r)[:-1]: r.folder for r in found if r.folder != name}


def _commit(spark: SparkSession, root: str, snapshot: Snapshot) -> None:
    """Take the snapshot's number, or raise if it is taken."""
    jvm, target = spark._jvm, version_path(root, snapshot.version)
    staged = f"{root}/{VERSIONS}/.{uuid.uuid4().hex}"
    system, place = hadoop_path(spark, staged)
    stream = system.create(place, False)
    try:
        stream.write(bytearray(snapshot.to_json().encode()))
    finally:
        stream.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(place, jvm.org.apache.hadoop.fs.Path(target), no_options)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        system.delete(place, False)
        raise ConcurrentWrite(f"version {snapshot.version} of {root} is there already") from error


def publish(
    df: DataFrame, root: str, table: S.Table, mode: str = OVERWRITE, stream: tuple[str, int] | None = None, base: Snapshot | None = None
) -> dict[Keys, str]:
    """Publish ``df`` in one version and return the partitions that changed, with their folders; nothing to change adds no version.

    ``overwrite_partitions`` replaces what the rows hold: their partitions or, if the table has a finer ``unit``, the units in them; ``skip``
    takes only rows of partitions that are not stored; ``append`` adds. ``stream`` names a source and the number of its batch: a
    batch that is not newer than the last one taken changes nothing. ``base`` is the version the caller built upon, by default the current one.
    """
    if mode not in (OVERWRITE, SKIP, APPEND):
        raise ValueError(f"unknown mode {mode!r}")
    rows, spark = conform(df, table), df.sparkSession
    found = base or current(spark, root)
    if found is None and any(not name.startswith("commit=") for name in folder_names(spark, root)):
        raise ValueError(f"{root} holds files of another layout; write them to a new root with `convert`")
    old = found or Snapshot()
    if stream and old.streams.get(stream[0], -1) >= stream[1]:
        return {}
    if mode == SKIP and old.folders:
        stored = spark.createDataFrame(list(old.folders), ", ".join(f"`{k}` string" for k in table.keys))
        rows = rows.join(stored, [rows[k].eqNullSafe(stored[k]) for k in table.keys], "left_anti")
    changed = _write_folder(rows, root, table)
    merges = mode == APPEND or (mode == OVERWRITE and table.unit and set(table.unit) != set(table.keys))
    touched = [keys for keys in changed if keys in old.folders] if merges else []
    if touched:
        new = read_folders(spark, table, root, [changed[k] for k in touched])
        kept = read_folders(spark, table, root, [old.folders[k] for k in touched])
        if mode == OVERWRITE:
            units = new.select(*[F.col(c).alias(f"__{c}") for c in table.unit]).distinct()
            same = [kept[c].eqNullSafe(units[f"__{c}"]) for c in table.unit]
            kept = kept.join(units, same, "left_anti")
        changed |= _write_folder(kept.unionByName(new), root, table)
    if changed or stream:
        streams = old.streams | dict([stream] if stream else [])
        _commit(spark, root, Snapshot(old.version + 1, old.folders | changed, streams))
    return changed


def convert(df: DataFrame, root: str, table: S.Table) -> dict[Keys, str]:
    """Write the rows of a table of any layout as the first version of a new snapshot table."""
    if current(df.sparkSession, root) is not None:
        raise ValueError(f"{root} is a snapshot table already")
    return publish(df, root, table, OVERWRITE)


def vacuum(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Delete the commit folders that none of the last ``keep`` versions uses; returns how many. Readers and writers must be idle."""
    now = current(spark, root)
    if now is None:
        return 0
    live = set()
    for number in range(max(1, now.version - keep + 1), now.version + 1):
        live |= {folder.split("/", 1)[0] for folder in load_version(spark, root, number).folders.values()}
    old = [n for n in folder_names(spark, root) if n.startswith("commit=") and n not in live]
    for name in old:
        system, place = hadoop_path(spark, f"{root}/{name}")
        system.delete(place, True)
    return len(old)


def register_changed(spark: SparkSession, name: str, table: S.Table, root: str, changed: dict[Keys, str]) -> None:
    """Point the catalog's partitions to the folders just published, some hundred per statement; nothing else is listed or touched."""

    def spec(keys: Keys) -> str:
        def literal(value: str | None) -> str:
            escaped = value.replace("\\", "\\\\").replace("'", "\\'") if value is not None else ""
            return "null" if value is None else f"'{escaped}'"

        return "PARTITION (" + ", ".join(f"`{k}`={literal(v)}" for k, v in zip(table.keys, keys)) + ")"

    entries = list(changed.items())
    for low in range(0, len(entries), _STATEMENT_PARTITIONS):
        part = entries[low : low + _STATEMENT_PARTITIONS]
        places = [(spec(keys), f"{root}/{folder}".replace("'", "\\'")) for keys, folder in part]
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(s for s, _ in places))
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"{s} LOCATION '{p}'" for s, p in places))


def stored_partitions(spark: SparkSession, root: str) -> Sequence[Keys]:
    """Key values of the partitions stored now, from the version file alone."""
    found = current(spark, root)
    return list(found.folders) if found else []
