"""Stored tables and files: partitioned scans, file inventories, CSV and nested results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe import schemas as S
from marketframe.sources.snapshots import any_file, current

# The columns of Spark's binaryFile source.
_FILE_COLUMNS = [
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
]


def read_table(spark: SparkSession, table: S.Table, root: str) -> DataFrame:
    """Scan a stored table. The schema is given, so key values such as ``0001326801`` stay text.

    Of a snapshot table the newest version is read: the frame keeps to its folders, whatever is published later.
    """
    snapshot = current(spark, root)
    if snapshot is not None:
        return read_folders(spark, table, root, list(snapshot.folders.values()))
    return spark.read.schema(table.schema).parquet(root)


def read_folders(spark: SparkSession, table: S.Table, root: str, folders: Sequence[str]) -> DataFrame:
    """Some partition folders of a snapshot table."""
    if not folders:
        return spark.createDataFrame([], table.schema)
    rows = spark.read.schema(table.schema).option("basePath", root).parquet(*[f"{root}/{f}" for f in folders])
    return rows.select(*table.schema.names)


def scan_series(
    spark: SparkSession,
    root: str,
    series: Sequence[str],
    years: tuple[int, int],
    require_any: bool = True,
    table: S.Table = S.MACRO,
) -> DataFrame:
    """Rows of some series and years. Both conditions prune partitions; absent partitions are simply not there.

    The check that there are any lists the folders of the wanted series only.
    """
    first, second = table.keys
    wanted = F.col(first).isin(*series) & F.col(second).cast("int").between(*years)
    if require_any:
        snapshot = current(spark, root)
        if snapshot is not None:
            there = [folder for keys, folder in snapshot.folders.items() if keys[0] in set(series)]
        else:
            there = [folder for folder in (f"{first}={s}" for s in series) if has_files(spark, f"{root}/{folder}")]
        stored = [f"{root}/{folder}" for folder in there]
        if not stored or partitions(spark, stored, [second], root).where(F.col(second).cast("int").between(*years)).isEmpty():
            raise ValueError(f"no data under {root} for series {list(series)} in {years[0]}-{years[1]}")
    return read_table(spark, table, root).where(wanted)


def missing_series(wanted: DataFrame, present: DataFrame, key: str = "series_id") -> DataFrame:
    """Wanted series that have no rows at all."""
    return wanted.select(key).distinct().join(present.select(key).distinct(), key, "left_anti")


def has_files(spark: SparkSession, root: str) -> bool:
    """Whether anything is stored below ``root``, which need not exist."""
    return any_file(spark, root)


def file_inventory(
    spark: SparkSession, root: str | list[str], keys: Sequence[str] = (), base: str | None = None
) -> DataFrame:
    """``(keys..., path, modified, length)`` of the files below ``root``, or below some folders of the table at ``base``.

    File contents are not read. Of a snapshot table only the newest version's folders are listed.
    """
    snapshot = current(spark, root) if isinstance(root, str) and base is None else None
    if snapshot is not None:
        root, base = [f"{root}/{folder}" for folder in snapshot.folders.values()], root
    schema = T.StructType(_FILE_COLUMNS + [T.StructField(key, T.StringType()) for key in keys])
    if not root:
        return spark.createDataFrame([], schema).select(*keys, "path", F.col("modificationTime").alias("modified"), "length")
    reader = spark.read.format("binaryFile").schema(schema)
    files = (reader.option("basePath", base) if base else reader).load(root)
    return files.select(*keys, "path", F.col("modificationTime").alias("modified"), "length")


def partitions(spark: SparkSession, root: str | list[str], keys: Sequence[str], base: str | None = None) -> DataFrame:
    """Distinct partition key values that hold a file, from the listing alone."""
    return file_inventory(spark, root, keys, base).select(*keys).distinct()


def latest_file(files: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Newest file per group, or overall; equal times are settled by path."""
    newest = F.max(F.struct("modified", "path")).alias("latest")
    return files.groupBy(*by).agg(newest).select(*by, F.col("latest.path").alias("path"), F.col("latest.modified").alias("modified"))


def with_file(rows: DataFrame) -> DataFrame:
    """Add the file path and time each row was read from."""
    return rows.select(
        "*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified")
    )


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def read_results(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Nested per-symbol result records: one per line, as ``export_json`` writes them, or files that each hold one array."""
    return spark.read.schema(S.RESULTS).option("multiLine", not lines).json(path)
