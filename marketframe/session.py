"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "marketframe", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """A session with the settings the operators rely on: UTC, adaptive execution, dynamic overwrite."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A machine-local folder is chosen only for a local master; on a cluster the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder when running on a cluster")
    chosen = tempfile.mkdtemp(prefix="marketframe-")
    spark.conf.set("spark.checkpoint.dir", chosen)
    return chosen


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/marketframe/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Jobs that end in here leave no shuffle files: Spark removes them with the job, not when the driver next collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on shared storage, so later uses see the same rows even after executor loss."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, limit: int = 100_000, rows_of: DataFrame | None = None) -> DataFrame:
    """Mark ``df`` for broadcast once it is known to hold at most ``limit`` rows; otherwise leave the join to Spark.

    The rows counted are those of ``rows_of`` when that is a cheaper upper bound. Size estimates of aggregates
    carry the size of their input, so a small result of a large table is not recognised without counting.
    """
    counted = (df if rows_of is None else rows_of).count()
    return F.broadcast(df) if counted <= limit else df
