"""Exact dedup by distributed most-significant-digit radix partitioning.

A digit is the next piece of the text's bytes, eight times as long in each round. Rows are grouped by (group so far,
digit); groups of one are done, groups whose texts end here are equal, all others go on with their remaining bytes.
Equality is decided by the bytes themselves. Hot groups are pre-aggregated before the shuffle, and joining rows to
their groups leaves skewed keys to adaptive splitting, so no group is ever gathered in a task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import SPACE, cut, text_or_empty

FIRST_DIGIT, GROWTH = 64, 8


def normalised(text: Column) -> Column:
    return F.regexp_replace(text_or_empty(text), SPACE, "")


def radix_groups(df: DataFrame, text: Column | None = None) -> DataFrame:
    """``df`` must have doc_id; the result has doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space; null counts as empty. The row with the most code points
    stays, of those the one with the smallest doc_id (of any type that has an order; a null doc_id comes last). Rows that
    repeat both are kept or dropped together. One row comes out for each that goes in, without its other columns; an empty
    table gives none.
    """
    raw = text if text is not None else F.col("text")
    norm = normalised(raw)
    rows = df.select(
        "doc_id",
        F.char_length(text_or_empty(raw)).alias("chars"),
        F.unhex(F.sha2(norm, 256)).alias("sha"),
        F.lit(0).cast("long").alias("gid"),
        norm.cast("binary").alias("rest"),
    )
    done, digit = [], FIRST_DIGIT
    while True:
        here = rows.withColumns(
            {"digit": F.substring("rest", 1, digit), "ended": F.octet_length("rest") <= digit, "rest": F.expr(f"substring(rest, {digit + 1})")}
        )
        groups = here.groupBy("gid", "digit", "ended").agg(
            F.count("*").alias("n"), F.min(F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("none"), "doc_id")).alias("best")
        )
        groups = cut(groups.filter("n > 1").withColumn("next", F.monotonically_increasing_id()))
        # The groups grow with the corpus, so they are never broadcast, also where they happen to be few.
        joined = here.join(groups.hint("merge"), ["gid", "digit", "ended"], "left").select(
            "doc_id", "chars", "sha", "n", "best",
            F.col("next").alias("gid"),
            F.when(F.col("n").isNotNull() & ~F.col("ended"), F.col("rest")).alias("rest"),
        )
        joined = cut(joined)
        over = joined.filter("rest IS NULL")
        done.append(
            over.select(
                "doc_id",
                F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
                F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
                (F.col("n").isNull() | ((F.col("chars") == -F.col("best.less")) & F.col("doc_id").eqNullSafe(F.col("best.doc_id")))).alias("kept"),
                F.lower(F.hex("sha")).alias("text_sha256"),
            )
        )
        rows = joined.filter("rest IS NOT NULL").select("doc_id", "chars", "sha", "gid", "rest")
        if rows.isEmpty():
            return reduce(DataFrame.unionAll, done)
        digit *= GROWTH


def drop_exact_copies(df: DataFrame) -> DataFrame:
    """``df`` without the documents whose text another document keeps; doc_id must tell the documents apart. Rows with a
    null doc_id and all columns stay."""
    gone = radix_groups(df).filter(~F.col("kept")).select(F.col("doc_id").alias("id")).distinct()
    rows = df.select(F.struct("*").alias("row"))
    return rows.join(gone, F.col("row.doc_id") == F.col("id"), "left_anti").select("row.*")
