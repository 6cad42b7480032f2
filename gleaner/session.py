"""Sessions with the settings that the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    """A session; what a cluster already sets is kept."""
    builder = SparkSession.builder.appName("gleaner")
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | more).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
