"""Trainer states: which file holds a model's history, and the points of its loss curves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE = "trainer_state.json"
SCHEMA = "log_history array<struct<step:bigint,loss:double,eval_loss:double>>"
CHECKPOINT = r"/checkpoint-([0-9]+)/[^/]*$"


def read_states(spark: SparkSession, root: str) -> DataFrame:
    """path, log_history of every state below ``root``."""
    found = spark.read.schema(SCHEMA).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", STATE).json(root)
    return found.select(F.col("_metadata.file_path").alias("path"), "log_history")


def latest_states(states: DataFrame) -> DataFrame:
    """One row per model: its own state if there is one, else that of the checkpoint with the highest number. Only paths
    are compared; one join brings the history."""
    number = F.nullif(F.regexp_extract("path", CHECKPOINT, 1), F.lit("")).cast("long")
    model = F.regexp_replace("path", r"(/checkpoint-[0-9]+)?/[^/]*$", "")
    best = states.select(model.alias("model"), "path", F.coalesce(number, F.lit((1 << 63) - 1)).alias("n")).groupBy("model").agg(F.max_by("path", "n").alias("path"))
    return states.join(best, "path").select("model", "path", "log_history")


def loss_points(states: DataFrame) -> DataFrame:
    """path, step, series (loss or eval_loss), value; a log entry has one, both or neither."""
    logs = states.select("path", F.inline("log_history"))
    return logs.unpivot(["path", "step"], ["loss", "eval_loss"], "series", "value").filter("value IS NOT NULL")
