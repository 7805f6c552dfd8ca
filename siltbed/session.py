"""Session settings the engine is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # Model calls have effects outside Spark, so a task is not run twice at once.
    "spark.speculation": "false",
}


def session(app: str = "siltbed", **settings: str) -> SparkSession:
    """A session with the engine's settings; keyword arguments use _ for . in setting names."""
    extra = {k.replace("__", "-").replace("_", "."): v for k, v in settings.items()}
    return SparkSession.builder.appName(app).config(map=SETTINGS | extra).getOrCreate()
