"""Session settings the plans rely on; on a cluster set the same ones at submit time."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins whose build side fits a task's memory in every partition hash it instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | str = "*", name: str = "tierstar", **more: str) -> SparkSession:
    """A local session for tests and measurements."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
    builder = builder.config("spark.sql.shuffle.partitions", "8")
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in more.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
