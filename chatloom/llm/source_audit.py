"""Source divergence audit: how far the word use of each source lies from every other of its language, and in which terms.

Counts are summed by (lang, source, term) once. Each language's kept terms get dense numbers inside blocks of bounded size;
a group's counts are one sorted array of (term number, count) per block. For each unordered pair of a language's sources
and each block the two arrays are brought together, the shorter one's numbers are sought in the longer one by galloping,
and the terms that both have, that one of them has and that neither has are priced, which serves both directions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import cut
from ._termcounts import term_counts

#: Texts of a language that hold a term, at least, for it to be kept.
LEAST_TEXTS = 10
#: Ranks of the terms that tell a source from its language.
TOP_TERMS = 10
#: Kept terms in a block, about: what a pair's task holds of either side.
BLOCK_TERMS = 1 << 15
SCALE = 1_000_000_000
#: Bytes that are no letters: terms are runs of ASCII letters and of everything beyond ASCII.
NOT_LETTER = np.zeros(256, bool)
NOT_LETTER[:128] = [not chr(b).isalpha() for b in range(128)]


def _share(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), exact for counts of 64 bits."""
    over = f"CAST(CAST({n} + 2 AS DECIMAL(20, 0)) * {SCALE}BD AS DECIMAL(38, 0))"
    return F.expr(f"1 + ({over} div CAST({total} + 2 * {terms} AS DECIMAL(38, 0)))")


def _gap(p: str | Column, q: str | Column) -> Column:
    """floor((p - q)^2 / (p + q)); with shares of at most SCALE + 1 it fits in 64 bits."""
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q}))")


def prices(counts: np.ndarray, total: int) -> np.ndarray:
    """The shares of counts out of ``total`` (counts of the group plus 2 for each kept term), in whole numbers. Counts of more
    than 9 digits go through Python's numbers, as their product with SCALE passes 64 bits."""
    if len(counts) and int(counts.max()) + 2 > (1 << 63) // SCALE - 1:
        return np.array([1 + SCALE * (int(c) + 2) // total for c in counts], np.int64)
    return 1 + SCALE * (counts.astype(np.int64) + 2) // total


def gaps(p: np.ndarray, q: np.ndarray) -> int:
    return int(((p - q) ** 2 // (p + q)).sum())


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Where each of the sorted numbers ``short`` is or would be in ``long``: leaps of 64 over ``long``, then halved steps
    inside the leap, for all numbers side by side."""
    coarse = np.searchsorted(long[::64], short, "right") - 1
    low = np.maximum(coarse, 0) * 64
    step = np.full(len(short), 32)
    at = low.copy()
    for _ in range(6):
        ahead = np.minimum(at + step, len(long))
        at = np.where(long[ahead - 1] < short, ahead, at)
        step >>= 1
    return np.where((at < len(long)) & (long[np.minimum(at, len(long) - 1)] < short), at + 1, at)


def pair_gap(ids_a: np.ndarray, p: np.ndarray, ids_b: np.ndarray, q: np.ndarray, p0: int, q0: int) -> tuple[int, int]:
    """(summed gap, distinct terms) of two sorted arrays: terms of both, and of one side only against the other's share of
    an absent term, ``p0`` and ``q0``."""
    if len(ids_a) > len(ids_b):
        ids_a, p, p0, ids_b, q, q0 = ids_b, q, q0, ids_a, p, p0
    if not len(ids_a):
        return gaps(np.int64(p0), q) if len(q) else 0, len(q)
    at = gallop(ids_a, ids_b)
    both = (at < len(ids_b)) & (ids_b[np.minimum(at, len(ids_b) - 1)] == ids_a)
    rest = np.ones(len(ids_b), bool)
    rest[at[both]] = False
    told = gaps(p[both], q[at[both]]) + gaps(p[~both], np.int64(q0)) + gaps(np.int64(p0), q[rest])
    return told, len(ids_a) + int(rest.sum())


def _pair_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a pair and a block with both arrays (null where a source has no term of the block) to summed gap and terms."""
    for batch in batches:
        get = {n: batch.column(n) for n in batch.schema.names}
        sums, terms = [], []
        for i in range(batch.num_rows):
            side = []
            for s in "ab":
                row = get[f"terms_{s}"][i].values
                ids, n = (np.empty(0, np.int64),) * 2 if row is None else (row.field(0).to_numpy().astype(np.int64), row.field(1).to_numpy())
                total = get[f"total_{s}"][i].as_py()
                side += [ids, prices(n, total), 1 + 2 * SCALE // total]
            told, known = pair_gap(side[0], side[1], side[3], side[4], side[2], side[5])
            sums.append(told)
            terms.append(known)
        yield pa.record_batch([get["lang"], get["a"], get["b"], pa.array(sums, pa.int64()), pa.array(terms, pa.int64())], ["lang", "a", "b", "gap", "terms"])


def divergence(docs: DataFrame, least_texts: int = LEAST_TEXTS, top_terms: int = TOP_TERMS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has for each source every other one of its language with the
    gap summed over the language's kept terms; part ``term`` has a source's first ``top_terms`` terms that it uses more than
    its language does. Ranks run from 1 by value, highest first, then by item.

    Null text, lang and source count as empty. A source without terms takes part with the share of absent terms; where a
    language keeps no term, all its pairs have value 0. Repeated rows count as often as they stand; other columns are
    ignored; an empty table has no rows. One source of a language has no pair."""
    spark = docs.sparkSession
    groups = {n: F.coalesce(F.col(n), F.lit("")) for n in ("lang", "source")}
    counted = cut(term_counts(docs, groups, NOT_LETTER))
    words = counted.filter("term IS NOT NULL")
    kept = words.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("texts").alias("texts")).filter(F.col("texts") >= least_texts)
    kept = cut(kept.select("lang", "term", "n_lang"))
    # Only two numbers come to the driver. Blocks are of a language each, by the term's hash, so none holds much more than the others.
    blocks = max(1, -(-kept.count() // block_terms))
    kept = kept.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int"))
    kept = kept.withColumn("id", F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")))
    used = cut(words.join(kept, ["lang", "term"]).select("lang", "source", "term", "block", "id", "n", "n_lang"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("total_lang"))
    sizes = used.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    of_group = counted.filter("term IS NULL").select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    of_group = cut(of_group.select("lang", "source", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("v", F.lit(0)).alias("v"), "total_lang"))
    return _pairs(used, of_group).unionByName(_terms(used, of_group, top_terms))


def _pairs(used: DataFrame, of_group: DataFrame) -> DataFrame:
    total = (F.col("size") + 2 * F.col("v")).alias("total")
    side = {s: of_group.select("lang", F.col("source").alias(s), "v", total.alias(f"total_{s}")) for s in "ab"}
    pairs = cut(side["a"].join(side["b"].drop("v"), "lang").filter("a < b"))
    key = ["lang", "a", "b", "total_a", "total_b"]
    arrays = cut(used.groupBy("lang", "source", "block").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("terms")))
    of_pair = {s: pairs.select(key).join(arrays.withColumnRenamed("source", s), ["lang", s]).select(*key, "block", F.col("terms").alias(f"terms_{s}")) for s in "ab"}
    # A pair's block is one row of either side at most.
    priced = of_pair["a"].join(of_pair["b"], [*key, "block"], "full").mapInArrow(_pair_tasks, "lang string, a string, b string, gap long, terms long")
    summed = priced.groupBy("lang", "a", "b").agg(F.sum("gap").alias("gap"), F.sum("terms").alias("terms"))
    absent = [F.expr(f"1 + {2 * SCALE} div nullif(total_{s}, 0)") for s in "ab"]
    none = F.when(F.col("v") > 0, (F.col("v") - F.coalesce("terms", F.lit(0))) * _gap("p0", "q0")).otherwise(0)
    told = pairs.join(summed, ["lang", "a", "b"], "left").withColumns({"p0": absent[0], "q0": absent[1]})
    told = told.select("lang", "a", "b", (F.coalesce("gap", F.lit(0)) + none).alias("value"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    rows = told.select("lang", ways.alias("way"), "value").select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def _terms(used: DataFrame, of_group: DataFrame, top_terms: int) -> DataFrame:
    priced = used.join(of_group, ["lang", "source"]).withColumns({"p": _share("n", "size", "v"), "q": _share("n_lang", "total_lang", "v")})
    more = priced.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap("p", "q").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return more.withColumn("rank", rank).filter(F.col("rank") <= top_terms)
