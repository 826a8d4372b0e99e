"""Session for local runs and tests. On a cluster, use the session you are given."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "tidyledger", memory: str = "12g") -> SparkSession:
    """Single-machine session with one shuffle partition per core and no web page."""
    n = os.cpu_count() if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.warehouse.dir", os.path.join(tempfile.gettempdir(), "tidyledger-warehouse"))
        .getOrCreate()
    )
