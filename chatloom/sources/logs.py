"""Log files of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.sources.jsonl import read_lines


def read_logs(spark: SparkSession, folder: str) -> DataFrame:
    """file, mtime, line_no (from 1), value of the lines of the files right in ``folder``; folders in it are left out, empty
    files have no lines."""
    lines = read_lines(spark, folder).select(F.col("path").alias("file"), (F.col("line_no") + 1).alias("line_no"), F.col("raw").alias("value"))
    times = spark.read.format("binaryFile").load(folder).select(F.col("_metadata.file_path").alias("file"), F.col("modificationTime").alias("mtime"))
    return lines.join(times, "file").select("file", "mtime", "line_no", "value")


def oldest_first(reports: DataFrame) -> DataFrame:
    """Reports by mtime, then by name."""
    return reports.orderBy("mtime", "file")
