"""Incremental load: process the files that arrived since the last run, then stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marketframe import schemas as S
from marketframe.sinks.snapshots import publish
from marketframe.sinks.tables import APPEND, conform


def ingest_available_now(
    spark: SparkSession,
    source: str,
    root: str,
    table: S.Table,
    checkpoint: str,
    source_schema: T.StructType,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    file_format: str = "json",
    max_files: int = 1000,
) -> None:
    """Append every new source file to the table exactly once.

    The stream's checkpoint remembers the files already taken. Each batch is published as one version of a snapshot table, which also records the
    batch's number: a batch that is repeated after a failure is found there and changes nothing. Of the stored table only the partitions a batch touches
    are read, and they are compacted on the way. Batch writers share the table. ``transform`` is stateless and runs on every batch.
    """
    arriving = (
        spark.readStream.format(file_format)
        .schema(source_schema)
        .option("maxFilesPerTrigger", max_files)
        .load(source)
    )

    def take(batch: DataFrame, number: int) -> None:
        publish_batch(conform(transform(batch), table), number, root, table, checkpoint)

    query = (
        arriving.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def publish_batch(rows: DataFrame, number: int, root: str, table: S.Table, stream: str) -> None:
    """Add the rows of batch ``number`` of a stream to the table; running it again for the same number changes nothing."""
    publish(rows, root, table, APPEND, (stream, number))
