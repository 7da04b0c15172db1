"""Few-shot examples: k different rows of a pool for each prompt, drawn without pairing prompts and pool."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def arithmetic_hash(id_col: Column, seed: int) -> Column:
    """32 bits from an integer id, the same in any SQL engine."""
    return (F.pmod(id_col, F.lit(1 << 31)) * 2654435761 + seed) % (1 << 32)


def numbered(df: DataFrame, rank: Column, tie: str, buckets: int = 4096) -> DataFrame:
    """Add ``place``: 0, 1, ... in the order of (rank, tie). Rank has 32 bits; rows are ordered within its buckets only."""
    x = df.withColumn("_r", rank).withColumn("_b", F.expr(f"_r div {(1 << 32) // buckets}"))
    c = x.groupBy("_b").agg(F.count("*").alias("_n"))
    c = c.select("_b", (F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_b").orderBy("_r", tie)) - 1 + F.col("_before")
    return x.join(c, "_b").select(*df.columns, place.cast("long").alias("place"))


def draw(prompt_id: Column, n: int, k: int, seed: int) -> Column:
    """min(k, n) different numbers below n, each set equally likely: a number already drawn gives way to the newest."""
    none = F.array().cast("array<bigint>")
    if n <= 0:
        return none

    def step(got: Column, j: Column) -> Column:
        t = F.pmod((arithmetic_hash(prompt_id, seed) + j * 40503) % (1 << 32), j + 1)
        return F.array_append(got, F.when(F.array_contains(got, t), j).otherwise(t))

    return F.aggregate(F.sequence(F.lit(max(n - k, 0)).cast("long"), F.lit(n - 1).cast("long")), none, step)


def few_shot(prompts: DataFrame, prompt_id: str, pool: DataFrame, pool_id: str, k: int = 5, seed: int = 42) -> DataFrame:
    """One row per prompt and example: prompt_id, shot (from 0), and the columns of the pool."""
    places = prompts.select(prompt_id, F.posexplode(draw(F.col(prompt_id), pool.count(), k, seed)).alias("shot", "place"))
    return places.join(numbered(pool, arithmetic_hash(F.col(pool_id), seed), pool_id), "place").drop("place")
