"""Session factory for local work; on a cluster the caller's session is used as it is."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "vitrine", **conf: str) -> SparkSession:
    """A session with the settings the library is tested under (UTC, AQE, Arrow)."""
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="vitrine-"))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
