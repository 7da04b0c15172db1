"""Joins, labels, mixing and sampling of chat datasets."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from chatloom.functions.strings import index_letter, letter_of, non_empty, strip
from chatloom.functions.turns import assistant_index, first_value, user_index
from chatloom.operators.sampling import arithmetic_hash, few_shot


def condensed_letter(abc: Column, answer_idx: Column, label: Column, idx: Column) -> Column:
    return F.coalesce(letter_of(abc), letter_of(answer_idx), letter_of(label), index_letter(idx))


def condensed_text(answer_text: Column, label: Column) -> Column:
    return F.coalesce(non_empty(answer_text), F.when(letter_of(label).isNull(), non_empty(label)))


def source_ranges(counts: DataFrame) -> DataFrame:
    """(pos, path, n) to inclusive row ranges of a merged file; an empty source has an empty range. One row a source."""
    upto = F.sum("n").over(Window.orderBy("pos"))
    return counts.select("path", "pos", (upto - F.col("n")).alias("range_start"), (upto - 1).alias("range_end"))


def attribute_rows(rows: DataFrame, ranges: DataFrame, index: str = "row_index", width: int = 1 << 16) -> DataFrame:
    """Source and index within it of each global row index; null outside. An equi-join on blocks of the index."""
    r = ranges.filter("range_end >= range_start").withColumn("blk", F.explode(F.sequence(F.expr(f"range_start div {width}"), F.expr(f"range_end div {width}"))))
    x = rows.withColumn("_blk", F.expr(f"{index} div {width}"))
    on = (x["_blk"] == r["blk"]) & x[index].between(r["range_start"], r["range_end"])
    return x.join(r, on, "left").select(*rows.columns, "path", (x[index] - r["range_start"]).alias("source_index"))


def enrich(rows: DataFrame, source: DataFrame, keys: list[str], labels: list[str]) -> DataFrame:
    """Left join of labels by provenance; ``lookup`` tells hit, miss, or a source row without labels."""
    wanted = source.join(rows.select(*keys).distinct(), keys, "left_semi")
    s = wanted.select(*keys, *[F.col(c).alias(f"_{c}") for c in labels], F.lit(True).alias("_hit"))
    out = rows.join(s, keys, "left")
    some = F.coalesce(*[F.col(f"_{c}").cast("string") for c in labels]).isNotNull()
    lookup = F.when(F.col("_hit").isNull(), "source_lookup_miss").when(~some, "source_row_without_labels").otherwise("enriched")
    return out.select(*rows.columns, *[F.col(f"_{c}").alias(c) for c in labels], lookup.alias("lookup"))


def smallest(df: DataFrame, rank: Column, n: int, tie: str, buckets: int = 4096) -> DataFrame:
    """Add ``chosen``: exactly the n rows of smallest (rank, tie). Counts by bucket leave only the boundary bucket to order."""
    x = df.withColumn("_r", rank).withColumn("_b", F.expr(f"_r div {(1 << 32) // buckets}"))
    c = x.groupBy("_b").agg(F.count("*").alias("_n"))
    c = c.withColumn("_before", F.sum("_n").over(Window.orderBy("_b")) - F.col("_n"))
    x = x.join(c, "_b").withColumn("_edge", (F.col("_before") < n) & (F.col("_before") + F.col("_n") > n))
    edge = Window.partitionBy(F.when(F.col("_edge"), F.lit(-1)).otherwise(F.spark_partition_id())).orderBy("_r", tie)
    inside = x.filter("_edge").withColumn("chosen", F.row_number().over(edge) + F.col("_before") <= n)
    rest = x.filter("NOT _edge").withColumn("chosen", F.col("_before") + F.col("_n") <= n)
    return inside.unionByName(rest).select(*df.columns, "chosen")


def shuffled(df: DataFrame, id_col: str, seed: int) -> DataFrame:
    return df.orderBy(F.xxhash64(F.lit(seed), id_col))


def union_datasets(parts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in parts.items():
        df = df.withColumn("dataset", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def accuracy(df: DataFrame, *by: str) -> DataFrame:
    """Labelled rows, exact matches over all rows, and their ratio in percent (null without labelled rows)."""
    labeled = F.count_if(F.coalesce("label_letter", F.lit("")) != "")
    correct = F.count_if(F.coalesce("exact_match", F.lit(False)))
    return df.groupBy(*by).agg(labeled.alias("labeled"), correct.alias("correct"), F.try_divide(correct * 100.0, labeled).alias("pct"))


def with_defaults(df: DataFrame) -> DataFrame:
    """No match and no tries where nothing is said."""
    return df.withColumns({"exact_match": F.coalesce("exact_match", F.lit(False)), "try_count": F.coalesce("try_count", F.lit(0))})


def pending(df: DataFrame, attempt: int, resume: bool = False) -> Column:
    """Whether a row is tried: all in the first attempt unless resumed, else labelled rows without a match."""
    first = F.lit(attempt == 1 and not resume)
    wrong = ~F.coalesce("exact_match", F.lit(False)) & (F.coalesce("label_letter", F.lit("")) != "")
    return first | wrong


def generate(df: DataFrame, make: Callable[[list], list], prompt: str = "prompt", out: str = "output") -> DataFrame:
    """Batch generation: ``make`` maps a list of prompts to a list of texts, batch by batch in Python workers. Each text stays
    with its row, so nothing is joined by position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array(make(b.column(b.schema.names.index(prompt)).to_pylist()), pa.string())
            yield pa.record_batch([*b.columns, texts], [*b.schema.names, out])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField(out, StringType())]))


def retry_rounds(df: DataFrame, answer, match, rounds: int, resume: bool = False) -> DataFrame:
    """Up to ``rounds`` attempts; ``answer(attempt)`` gives the new text's Column, ``match`` tells whether it is right.
    Rows need value, label_letter, exact_match, try_count."""
    for attempt in range(1, rounds + 1):
        todo = pending(df, attempt, resume)
        new = F.when(todo, answer(attempt)).otherwise(F.col("value"))
        df = df.withColumns({"_todo": todo, "value": new})
        df = df.withColumns(
            {
                "exact_match": F.when(F.col("_todo"), match(F.col("value"), F.col("label_letter"))).otherwise(F.col("exact_match")),
                "try_count": F.when(F.col("_todo"), F.lit(attempt)).otherwise(F.col("try_count")),
            }
        ).drop("_todo")
    return df


def distill(
    df: DataFrame, make: Callable[[list, int], list], match: Callable[[Column, Column], Column], rounds: int, folder: str, resume: bool = False
) -> DataFrame:
    """Up to ``rounds`` attempts of a generator at the rows that are pending and have a ``prompt``; it ends early when there
    are none. ``make(prompts, attempt)`` gives the texts. Rows need value, label_letter, exact_match, try_count; the others
    stay.

    ``folder`` is the log of one run: attempt-N holds what attempt N had in hand, apart by whether the row is tried again,
    so a row is written once more only while it is open. Started again over the same folder, a run goes on after the last
    attempt that was written whole and removes what was half written; attempts that are done are not generated again. The
    folder must not serve another input."""
    spark, df = df.sparkSession, with_defaults(df)
    mark = "open_"
    while mark in df.columns:
        mark += "_"
    schema = StructType([*df.schema.fields, StructField(mark, IntegerType())])
    done = whole_attempts(spark, folder)

    def written(attempt: int) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{folder}/attempt-{attempt}")

    last = 0
    for attempt in range(1, rounds + 1):
        if attempt not in done:
            todo = pending(df, attempt, resume) & F.col("prompt").isNotNull()
            if df.filter(todo).isEmpty():
                break
            tried = generate(df.filter(todo), lambda prompts, n=attempt: make(prompts, n), out="_new").withColumn("value", strip(F.col("_new"))).drop("_new")
            tried = tried.withColumns({"exact_match": match(F.col("value"), F.col("label_letter")), "try_count": F.lit(attempt)})
            now = df.filter(~todo).unionByName(tried.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in df.schema.fields]))
            again = pending(now, attempt + 1) & F.col("prompt").isNotNull()
            now.withColumn(mark, again.cast("int")).write.partitionBy(mark).parquet(f"{folder}/attempt-{attempt}")
        last = attempt
        df = written(attempt).filter(F.col(mark) == 1).drop(mark)
    if not last:
        return df
    out = written(last).drop(mark)
    for attempt in range(1, last):
        out = out.unionAll(written(attempt).filter(F.col(mark) == 0).drop(mark))
    return out


def whole_attempts(spark: SparkSession, folder: str) -> set[int]:
    """Numbers of the attempts below ``folder`` that were written whole, from the first without a gap. Every other attempt's
    folder is removed."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {int(p.getPath().getName().removeprefix("attempt-")): p.getPath() for p in (fs.listStatus(root) if fs.exists(root) else []) if re.fullmatch(r"attempt-\d+", p.getPath().getName())}
    whole: set[int] = set()
    for n in sorted(found):
        if n == len(whole) + 1 and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(found[n], "_SUCCESS")):
            whole.add(n)
        else:
            fs.delete(found[n], True)
    return whole


def not_failed(df: DataFrame) -> DataFrame:
    """Rows whose label agreement is anything but fail, null included."""
    return df.filter(~F.col("label_agreement").eqNullSafe(F.lit("fail")))


def qa_pools(rows: DataFrame) -> DataFrame:
    """question, answer, labeled of the rows of conversations that ask and answer; labelled and other pairs are two pools."""
    conv = F.col("conversations")
    user, asst = user_index(conv), assistant_index(conv)
    asked = rows.filter(user.isNotNull() & asst.isNotNull())
    said = [strip(first_value(conv, i)).alias(n) for i, n in ((user, "question"), (asst, "answer"))]
    return asked.select(*[c for c in rows.columns if c != "conversations"], *said, (F.coalesce("label_letter", F.lit("")) != "").alias("labeled"))


def pool_prompts(pools: DataFrame, pair_id: str, ratio: float, k: int = 5, seed: int = 42) -> DataFrame:
    """labeled, prompt, shot and the pairs' columns: int(n * ratio) prompts for each pool of n pairs, each with min(k, n)
    different pairs of it. A pool without pairs is an error."""
    out = None
    sizes = {r["labeled"]: r["count"] for r in pools.groupBy("labeled").count().collect()}
    for labeled in (True, False):
        if not sizes.get(labeled):
            raise ValueError(f"no {'labelled' if labeled else 'unlabelled'} pairs")
        prompts = pools.sparkSession.range(int(sizes[labeled] * ratio)).withColumnRenamed("id", "prompt")
        drawn = few_shot(prompts, "prompt", pools.filter(F.col("labeled") == labeled), pair_id, k, seed)
        out = drawn if out is None else out.unionByName(drawn)
    return out


def expected_pairs(documents: DataFrame, each: int = 10, limit: int = 0) -> DataFrame:
    """How many documents there are and how many pairs they should give: ``each`` of every document, or the limit."""
    n = F.count("*")
    return documents.agg(n.alias("documents"), (F.lit(limit).cast("long") if limit else n * each).alias("expected"))


def enrichment_totals(merged: DataFrame) -> DataFrame:
    """Over rows with added and overwritten: how many there are, and what they got."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
    return merged.agg(F.count("*").alias("rows_enriched"), total("added").alias("fields_added"), total("overwritten").alias("fields_overwritten"))


def condense_counts(rows: DataFrame) -> DataFrame:
    """Counters over condensed rows: label_letter, label_text, source_path, source_index."""
    none = F.col("label_letter").isNull() & F.col("label_text").isNull()
    said = {"with_letter": "label_letter", "with_text": "label_text", "with_path": "source_path", "with_index": "source_index"}
    return rows.agg(F.count("*").alias("written"), *[F.count(c).alias(n) for n, c in said.items()], F.count_if(none).alias("without_label"))
