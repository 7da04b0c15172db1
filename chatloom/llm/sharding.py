"""Sharding by proportional stratified interleaving: every shard has the mixture of the whole.

Rows get a rank in their source by a seeded hash; ordering by the fractional rank (rank - 1/2) / n deals the sources
out evenly, and cutting that order into equal parts gives shards whose numbers of rows differ by one at most.
Ranks and the order are found bucket by bucket: a bucket holds a bounded number of rows, and prefix sums over the
buckets' counts say where each begins, so no source and no shard is ever sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import free_names, id_hash, text_or_empty

SEED = 5
N_SHARDS = 40
#: A bucket holds about so many rows, and so many bytes of text, at most.
BUCKET_ROWS, BUCKET_BYTES = 4_000, 16 << 20
#: Prefix sums over buckets are taken in blocks of so many.
PREFIX_BLOCK = 4_096


def _starts(sizes: DataFrame, parts: int) -> DataFrame:
    """(p, start): how many rows stand before each of the ``parts`` buckets of the fractional ranks. A source of few rows
    counts in the buckets it has rows in, so the table never has more rows than the documents, however many sources there
    are; the prefix sums run over blocks of buckets, then over the blocks."""
    few = F.col("all") < parts
    before = lambda p: F.expr(f"(2 * all * ({p}) + {parts - 1}L) div {2 * parts}L")
    each = sizes.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.least("all", F.lit(parts).cast("long")) - 1)))
    p = F.when(few, F.expr(f"((2 * i + 1) * {parts}L) div (2 * all)")).otherwise(F.col("i"))
    n = F.when(few, F.lit(1).cast("long")).otherwise(before("i + 1") - before("i"))
    counts = each.select(p.alias("p"), n.alias("n")).groupBy("p").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("block", F.expr(f"p div {PREFIX_BLOCK}L"))
    blocks = counts.groupBy("block").agg(F.sum("n").alias("in_block"))
    blocks = blocks.select("block", (F.sum("in_block").over(Window.orderBy("block")) - F.col("in_block")).alias("earlier"))
    within = F.sum("n").over(Window.partitionBy("block").orderBy("p")) - F.col("n")
    return counts.withColumn("within", within).join(blocks, "block").select("p", (F.col("within") + F.col("earlier")).alias("start"))


def interleave_shards(df: DataFrame, n_shards: int = N_SHARDS, source: str = "source", key: Column | None = None, seed: int = SEED) -> DataFrame:
    """Add ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0 within the shard) to ``df``. Where ``df`` has columns of
    these names, the new ones are ``shard_`` and ``slot_``; all columns stay.

    Law: the shards' numbers of rows differ by one at most. ``key`` orders the rows of a source (default: a seeded
    hash of the whole row); rows that agree in it are ordered by the columns of ``df``, so rows that are the same
    throughout are interchangeable. A null source is a source of its own, null texts and ids are values like others. An empty
    table stays empty. Copies of a text are not kept together: a group of copies larger than a shard could not be.

    The rows themselves are shuffled twice, in buckets of bounded rows and bytes.
    """
    shard, slot = free_names(df, "shard", "slot")
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    h = F.abs(F.coalesce(key if key is not None else id_hash(seed, *hashed), F.lit(0))).cast("long")
    of = F.col(f"`{source}`")
    base = df.select(F.struct("*").alias("row"), h.alias("h"), of.isNull().alias("none"), F.coalesce(of.cast("string"), F.lit("")).alias("s"))
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)).cast("long") for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    size = df.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(f"b{k}") for k, c in enumerate(texts)]).first()
    total, parts = size["n"], max(1, -(-size["n"] // BUCKET_ROWS), -(-sum(size[1:]) // BUCKET_BYTES))
    bucket = F.expr(f"shiftright(shiftright(h, 31) * {parts}L, 32)")
    base = base.withColumn("b", bucket)
    counts = base.groupBy("none", "s", "b").agg(F.count("*").alias("n"))
    of_source = Window.partitionBy("none", "s")
    counts = counts.select(
        "none", "s", "b",
        (F.sum("n").over(of_source.orderBy("b")) - F.col("n")).alias("before"),
        F.sum("n").over(of_source).alias("all"),
    )
    ties = [F.col(f"row.`{f.name}`") for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    rank = F.row_number().over(Window.partitionBy("none", "s", "b").orderBy("h", *ties))
    ranked = base.join(counts, ["none", "s", "b"]).withColumn("k", (rank + F.col("before")).cast("long"))
    # Fractional rank (2k - 1) / 2n; its bucket of `parts` in whole numbers, so that the offsets below are exact.
    ranked = ranked.withColumn("f", (2 * F.col("k") - 1) / (2 * F.col("all")))
    ranked = ranked.withColumn("p", F.expr(f"((2 * k - 1) * {parts}L) div (2 * all)"))
    sizes = base.groupBy("none", "s").agg(F.count("*").alias("all"))
    starts = _starts(sizes, parts)
    place = F.row_number().over(Window.partitionBy("p").orderBy("f", "none", "s")) - 1
    n = max(total, 1)
    dealt = ranked.join(starts, "p").withColumn("at", place + F.col("start"))
    dealt = dealt.withColumn("shard", F.expr(f"cast((at * {n_shards}L) div {n}L as int)"))
    dealt = dealt.withColumn("slot", F.expr(f"at - (shard * {n}L + {n_shards - 1}L) div {n_shards}L"))
    return dealt.select("row.*", F.col("shard").alias(shard), F.col("slot").alias(slot))


def shard_report(docs: DataFrame) -> DataFrame:
    """Where each document goes; null texts count as empty, other columns are ignored. The text is reduced to size and
    checksum before anything is shuffled."""
    raw = text_or_empty("text").cast("binary")
    narrow = docs.select("doc_id", "source", (F.octet_length(raw) + 16).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    return interleave_shards(narrow).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
