"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "areascore", **conf: str) -> SparkSession:
    """Session with UTC and adaptive execution; ``conf`` adds or overrides settings.

    The number of shuffle partitions is left to the cluster: adaptive execution
    merges small ones and splits skewed ones.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
