"""Helpers that several training-data operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.sources.scratch import scratch_dir

#: Words between the six ASCII white-space characters, as a Java pattern.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: the lineage ends there, and lost
    executors cost no recomputation of what came before."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/chatloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.cut_path = path
    return back


def drop(*tables: DataFrame) -> None:
    """Remove tables that ``cut`` wrote. Whatever was made of them must have been written since, or lost executors could
    not make it again."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.cut_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def word_count(col: str | Column = "text") -> Column:
    """Number of white-space separated words; null counts as empty."""
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")


def id_hash(seed: int, *cols: str | Column) -> Column:
    """A seeded hash of 63 bits; the same row gets the same value in every run and partitioning."""
    return F.xxhash64(F.lit(seed), *cols).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))


@contextmanager
def small_batches(spark: SparkSession, size: int = 8 << 20) -> Iterator[None]:
    """Let Python tasks of the jobs that run inside get about so many bytes at once, so that what they make of these fits
    beside the JVM. The session's setting comes back afterwards."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def free_names(df: DataFrame, *names: str) -> tuple[str, ...]:
    """The names, with as many underscores as keep them apart from the columns of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return tuple(out)
