"""Session helper for local runs; on a cluster the caller brings its own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "orrery", cores: int | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """A local session with AQE and Arrow on, as the tests and the bench use it."""
    n = cores or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("ORRERY_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
