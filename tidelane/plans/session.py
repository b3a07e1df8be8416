"""Session settings for a run of the library."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "tidelane", master: str | None = None, **settings: str) -> SparkSession:
    """A session with UTC days, adaptive plans and skew handling. Settings that the cluster
    already carries (memory, executors, spark.checkpoint.dir) are left alone."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # settled tables go when nothing refers to them any more
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
