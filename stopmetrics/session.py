"""Session settings the operators are written for. Any other session works too."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "stopmetrics", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
