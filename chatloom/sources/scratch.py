"""Folders for intermediate tables that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, as in tests, a local master gets a folder of its own; on a
    cluster that is an error."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("chatloom.scratch.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("chatloom.scratch.dir", shared)
    return shared.rstrip("/")
