"""A local session with the settings that the tests and the benchmark use."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tableloom")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it; on a cluster use --py-files instead."""
    root = str(Path(__file__).resolve().parent.parent)
    workers = spark.sparkContext.environment
    paths = [p for p in workers.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        workers["PYTHONPATH"] = os.pathsep.join([root, *paths])
