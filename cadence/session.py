"""Local session for tests and the benchmark (a cluster brings its own)."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cadence",
                  checkpoint_dir: str | None = None) -> SparkSession:
    """``checkpoint_dir``: used where the environment names no shared folder."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CADENCE_DRIVER_MEMORY", "8g"))
        # PySpark's call-site capture costs extra JVM round trips per column call.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir and spark.sparkContext.getCheckpointDir() is None and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark
