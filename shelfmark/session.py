"""A local session with the settings the library is tested under."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str = "shelfmark", cores: int | str | None = None, partitions: int = 8, memory: str = "6g") -> SparkSession:
    """A ``local[cores]`` session; on a cluster pass your own session instead."""
    cores = cores or os.environ.get("BENCH_CPUS") or 8
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
