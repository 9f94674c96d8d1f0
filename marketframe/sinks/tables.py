"""Writing tables: schema contract, Hive layout, idempotent modes, exports and catalog entries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe import schemas as S
from marketframe.session import broadcast_if_small, scratch_path
from marketframe.sources.snapshots import current
from marketframe.sources.tables import has_files, partitions

OVERWRITE, SKIP, APPEND = "overwrite_partitions", "skip", "append"
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class SchemaDrift(Exception):
    """The frame does not fit the table contract."""


def conform(df: DataFrame, table: S.Table) -> DataFrame:
    """Select the contract's columns and keys in order; extra columns are dropped.

    A missing column or another type raises. Widening an integer is allowed, and keys become text.
    """
    have = {f.name: f.dataType for f in df.schema}
    problems, out = [], []
    for field in table.schema:
        actual, is_key = have.get(field.name), field.name in table.keys
        if actual is None:
            problems.append(f"{field.name}: missing")
        elif actual == field.dataType:
            out.append(F.col(field.name))
        elif is_key or (isinstance(actual, _INTEGERS) and isinstance(field.dataType, T.LongType)):
            out.append(F.col(field.name).cast(field.dataType).alias(field.name))
        else:
            problems.append(f"{field.name}: {actual.simpleString()} instead of {field.dataType.simpleString()}")
    if problems:
        raise SchemaDrift(f"{table.name}: " + "; ".join(problems))
    return df.select(*out)


def new_partitions_only(df: DataFrame, spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Rows whose partition is not stored yet."""
    if not has_files(spark, root):
        return df
    return df.join(broadcast_if_small(partitions(spark, root, keys)), list(keys), "left_anti")


def write_table(df: DataFrame, root: str, table: S.Table, mode: str = OVERWRITE) -> None:
    """Write Snappy Parquet partitioned by the table's keys.

    ``overwrite_partitions`` replaces the partitions present in ``df`` and keeps the others, ``skip``
    leaves stored partitions untouched, ``append`` adds files.

    Rows are rebalanced by key before the write: small partitions give one file each, a partition far
    above the advisory size is split over several tasks and files. At the root of a snapshot table the write is published
    as a version (``sinks.snapshots``).
    """
    if mode not in (OVERWRITE, SKIP, APPEND):
        raise ValueError(f"unknown mode {mode!r}")
    rows, spark = conform(df, table), df.sparkSession
    if current(spark, root) is not None:
        from marketframe.sinks import snapshots  # builds on this module

        snapshots.publish(rows, root, table, mode)
        return
    if mode == SKIP:
        rows = new_partitions_only(rows, spark, root, table.keys)
    writer = rows.hint("rebalance", *table.keys).write.partitionBy(*table.keys).option("compression", "snappy")
    if mode == OVERWRITE:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)
    else:
        writer.mode("append").parquet(root)


def replace(df: DataFrame, path: str) -> None:
    """Replace a whole unpartitioned result."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def export_csv(df: DataFrame, path: str, columns: Sequence[str] | Mapping[str, str] | None = None) -> bool:
    """CSV with header and a fixed column list, or columns with their headings; says whether it wrote.

    Nothing is written for an empty frame.
    """
    headings = columns if isinstance(columns, Mapping) else {c: c for c in columns or df.columns}
    rows, seen = df.select(*[F.col(c).alias(h) for c, h in headings.items()]), Observation()
    staged = scratch_path(df.sparkSession, "export")
    # The plan runs once: rows are staged and counted on the way, and written as text only if there are any.
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(staged)
    if not seen.get["rows"]:
        return False
    ready = df.sparkSession.read.schema(rows.schema).parquet(staged)
    ready.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return True


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", True).json(path)


def create_table(spark: SparkSession, table: S.Table, root: str, name: str | None = None) -> str:
    """External table over ``root`` with the contract's columns and string keys. Returns the name."""
    name = name or table.name
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
    keys = ", ".join(f"`{k}`" for k in table.keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({keys}) LOCATION '{root}'")
    return name


def register_partition(spark: SparkSession, name: str, values: dict[str, str], location: str | None = None) -> None:
    """Add one partition (one or more keys) unless it is there."""
    spec = ", ".join(f"`{k}`='{v}'" for k, v in values.items())
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec}){place}")


def register_all(spark: SparkSession, name: str) -> None:
    """Register every partition found below the table's location."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


