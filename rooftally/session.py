"""Session settings the jobs are meant to run under."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime SQL settings; each can be set on a running session.
RUNTIME = {
    # Shuffle stages size their own partitions and split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles methods above 8000 bytes, and the cleaning step
    # fuses into one such method. Above this size Spark generates the same code
    # in small methods instead: 2-3 times faster on the cleaning step.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Opened JSON records have more fields than this, nested ones included, and are not fused
    # at all: fused, their cleaning exceeds what a method may hold and fails to compile.
    "spark.sql.codegen.maxFields": "40",
}


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where it is, when it is not installed on them."""
    root = str(Path(__file__).resolve().parents[1])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cores: str = "*", shuffle_partitions: int = 8, settings: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("rooftally")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())
