"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, **settings: str) -> SparkSession:
    """A session in UTC with adaptive execution. settings: more of Spark's, with _ for the dots."""
    builder = SparkSession.builder.appName("catalyne").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        builder = builder.master(master)
    for k, v in settings.items():
        builder = builder.config(k.replace("_", "."), v)
    return builder.getOrCreate()
