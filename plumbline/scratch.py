"""Intermediate tables and files of the core operators, in the folder that driver and executors share.

It is the one that ``spark.checkpoint.dir`` names; only a local master may do without (a temporary folder then).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """URI of a new folder (not created yet)."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = _local.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="plumbline-core-"))
    return f"{base.rstrip('/')}/core-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written once and read again: what is used several times is worked out once."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
