"""Session settings that the engine's operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: AQE re-plans joins, skew and partition counts at run time; LAST_WIN keeps the last of repeated JSON keys.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "loomtable", **more: str) -> SparkSession:
    """A session with the engine's settings; ``more`` has further ones, dots written as two underscores."""
    build = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in more.items()}).items():
        build = build.config(key, value)
    return build.getOrCreate()
