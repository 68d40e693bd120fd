"""Session settings that the engine expects; each can be overridden."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "caudal", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for k, v in (SETTINGS | settings).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
