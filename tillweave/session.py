"""Session settings this package expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(name: str, cores: str = "8", **settings: str) -> SparkSession:
    """A session on this machine, for tests and measurements."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    local = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **settings,
    }
    for key, value in local.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
