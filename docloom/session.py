"""A Spark session with the settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: maps merged by later rules keep the last value; times are UTC
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build(name: str = "docloom", **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for k, v in {**SETTINGS, **more}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def option(spark: SparkSession, name: str, default: str | None = None) -> str | None:
    """An engine setting (model names, keys, folders): spark.docloom.<name> of the session."""
    return spark.conf.get(f"spark.docloom.{name}", default)
