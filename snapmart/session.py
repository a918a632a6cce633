"""Session builder with the settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Plain Spark settings; a cluster sets its own executor sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Caps up to so many rows a group are trimmed before they shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    # Python's JSON reader keeps the last of repeated object keys.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def local_session(cpus: int | str = "*", memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("snapmart")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
