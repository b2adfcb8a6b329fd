"""Session defaults. ANSI stays on (Spark 4's default), time is UTC, AQE re-plans at run time."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | None = None, app: str = "plumbline", **conf: str) -> SparkSession:
    """A local session for tests and the bench. On a cluster, pass your own session to the operators instead."""
    n = cores or os.cpu_count() or 4
    builder = SparkSession.builder.master(f"local[{n}]").appName(app)
    settings = DEFAULTS | {"spark.sql.shuffle.partitions": str(n), "spark.driver.memory": "8g"} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
