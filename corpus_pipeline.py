"""A training-corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

All stages take nulls in any column, empty and very long texts, repeated rows, empty tables and further columns, whatever
their names; every stage keeps all columns, and all but the last add none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from chatloom.llm._common import scratch_dir, table
from chatloom.llm.decontaminate import decontaminate
from chatloom.llm.jaccard_join import drop_near_copies
from chatloom.llm.mixing import mix_documents
from chatloom.llm.sharding import interleave_shards
from chatloom.llm.toxicity import drop_toxic


def _small_batches(spark: SparkSession) -> None:
    """This application's setting: what Python tasks get at once fits in executors of 3 GB with two tasks each."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go. Null and empty texts stay unless labels speak against texts without words;
    without labels of both classes all documents stay."""
    _small_batches(spark)
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similar shingle sets, the one with the smallest doc_id stays. Documents without words and
    those with a null doc_id are linked with nothing; rows that repeat a doc_id are one document."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go; null and empty texts hold none, and an empty benchmark has none."""
    _small_batches(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents appear as often as the mix takes them: never, once or twice. A null source is a source; texts without words
    have size 0 and are taken by their hash alone."""
    return mix_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its ``shard`` and its ``slot`` there (``shard_`` and ``slot_`` where the table has these already). A null
    source is a source; rows that are the same throughout are interchangeable."""
    return interleave_shards(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The language models and the component search have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
