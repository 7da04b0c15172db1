"""Mixing sources to target weights with hash-threshold histograms.

Words are summed by source and hash bucket; the bucket in which a source's budget runs out is refined on further
bits of the hash, and the others are never looked at again. Rows below the threshold are taken once more than the
rest. Nothing is sorted but the tables of sources and buckets, and a smaller budget always takes a subset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import cut, id_hash, text_or_empty, word_count

# Fixed values of the mix: weights by rank of the source, share of all words, limit as a multiple of a source.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SEED = 20
#: Bits a level of the histogram looks at; LEVELS * LEVEL_BITS bits tell buckets of a few rows apart at any size.
LEVEL_BITS, LEVELS, HASH_BITS = 12, 4, 63


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``source, source_size, target`` from one row per source.

    Weights repeat along the sources in code-point order, null last. A share of all words is split by weight; what
    exceeds a source's cap is split again among the others. The fixed point of that is a common level ``f`` with
    target = min(cap * size, f * weight): in the order of cap*size/weight, the first source that stays below its cap
    tells f. The windows run over one row per source.
    """
    whole = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(rank, F.lit(len(weights))))
    s = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    budget = F.sum("source_size").over(whole) * F.lit(float(share))
    s = s.withColumn("f", (budget - before) / rest)
    s = s.withColumn("level", F.min(F.when(F.col("f") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), "f"))).over(whole))
    return s.select(
        "source", "source_size", F.coalesce(F.least("most", F.col("level.f") * F.col("weight")), F.col("most")).alias("target")
    )


def _bucket(level: int) -> Column:
    return F.shiftright("hash", HASH_BITS - LEVEL_BITS * level)


def hash_thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: ``copies`` that all its rows get, and ``below``: rows whose first LEVELS * LEVEL_BITS hash bits are
    less get one more. ``rows`` has source, size and hash. Only the boundary bucket of a source is refined."""
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    state = cut(targets).withColumn("copies", copies).withColumn("need", F.col("target") - F.col("copies") * F.col("source_size"))
    state = state.withColumn("prefix", F.lit(0).cast("long"))
    for level in range(1, LEVELS + 1):
        old = state.select(F.col("source").alias("s"), "prefix", "need")
        near = rows.join(old, rows["source"].eqNullSafe(old["s"]) & (_bucket(level - 1) == F.col("prefix")))
        sums = near.groupBy("source", _bucket(level).alias("bucket")).agg(F.sum("size").alias("in_it"), F.first("need").alias("need"))
        upto = F.sum("in_it").over(Window.partitionBy("source").orderBy("bucket"))
        edge = (
            sums.withColumn("upto", upto)
            .filter(F.col("upto") > F.col("need"))
            .groupBy("source")
            .agg(F.min(F.struct("bucket", "upto", "in_it")).alias("edge"))
            .select(F.col("source").alias("s"), "edge")
        )
        state = state.join(edge, state["source"].eqNullSafe(edge["s"]), "left").select(
            "source", "source_size", "target", "copies",
            F.coalesce(F.col("need") - F.col("edge.upto") + F.col("edge.in_it"), "need").alias("need"),
            F.coalesce("edge.bucket", F.lit(0).cast("long")).alias("prefix"),
            F.col("edge.in_it").alias("in_it"),
        )
        state = cut(state)  # one row per source
    # The last bucket holds one row, or rows of one hash: in if that comes nearer to the target.
    nearer = F.coalesce(F.col("in_it") < 2 * F.col("need"), F.lit(False)).cast("long")
    return state.select("source", "source_size", "target", "copies", (F.col("prefix") + nearer).alias("below"))


def plan_mix(sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The table of thresholds for ``sized``: rows of source, size, hash, read LEVELS + 1 times, so a table of its own."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return hash_thresholds(sized, source_targets(sizes, weights, share, cap))


def with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with source and hash, as ``row`` (a struct of all columns), with source_size, target and ``copies``: how often
    the row is taken."""
    p = plan.select(F.col("source").alias("s"), "source_size", "target", F.col("copies").alias("all_get"), "below")
    more = (F.shiftright("row.hash", HASH_BITS - LEVEL_BITS * LEVELS) < F.col("below")).cast("int")
    rows = rows.select(F.struct("*").alias("row"))
    joined = rows.join(p, F.col("row.source").eqNullSafe(F.col("s")), "left")
    return joined.select("row", "source_size", "target", (F.col("all_get") + more).alias("copies"))


def mix_hash() -> Column:
    return id_hash(SEED, "doc_id", text_or_empty("text"))


def mix_report(docs: DataFrame) -> DataFrame:
    """One row per document: how many of its words the mix takes. Rows that repeat doc_id and text are taken alike;
    null texts and texts without words have size 0; a null source is a source. Texts are read once."""
    sized = cut(docs.select("doc_id", "source", word_count().alias("size"), mix_hash().alias("hash")))
    done = with_copies(sized, cut(plan_mix(sized.select("source", "size", "hash"))))
    return done.select("row.doc_id", "row.size", "source_size", "target", (F.col("row.size") * F.col("copies")).alias("taken"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``, whatever their names. Null texts
    and texts without words have size 0 and are taken as often as their hash says; an empty table stays empty. Only sizes
    and hashes are looked at for the plan; the documents are read once and not shuffled."""
    sized = cut(docs.select("source", word_count().alias("size"), mix_hash().alias("hash")))
    plan = cut(plan_mix(sized))
    row = F.struct(F.struct("*").alias("doc"), "source", mix_hash().alias("hash"))
    taken = with_copies(docs.select(row.alias("x")).select("x.*"), plan).filter("copies > 0")
    return taken.select("row.doc", F.explode(F.sequence(F.lit(1), "copies"))).select("doc.*")
