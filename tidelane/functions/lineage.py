"""Cutting lineage in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session. A temporary one is made on a local master only."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named
    if current is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidelane-"))
        current = context.getCheckpointDir()
    return current


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path for a table in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/tidelane/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Materialise df once, so that several consumers neither rescan nor recompute its inputs."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


# Spark's setting for shuffle files that go at the end of a query.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run inside go when the query ends, not when the driver next happens to collect garbage;
    for a table that is written once, before a job that needs the disk as well."""
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_RELEASE)
        else:
            spark.conf.set(_RELEASE, before)
