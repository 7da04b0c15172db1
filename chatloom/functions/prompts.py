"""Prompts from templates and columns, and the number of tokens they take."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What the name of a template's place looks like.
PLACE = re.compile(r"\{(\w+)\}")


def fill(template: str, **values: Column) -> Column:
    """``template`` with each {name} replaced by its column; braces around other words stay. Null counts as empty."""
    parts, at = [], 0
    for m in PLACE.finditer(template):
        if m[1] in values:
            parts += [F.lit(template[at : m.start()]), F.coalesce(values[m[1]].cast("string"), F.lit(""))]
            at = m.end()
    return F.concat(*parts, F.lit(template[at:]))


def numbered_examples(examples: Column, template: str = "--- Example {n} ---\n<question>{question}\n<answer>{answer}\n\n") -> Column:
    """array<struct<question, answer>> as one text, examples counted from 1."""
    texts = F.transform(examples, lambda e, i: fill(template, n=i + 1, question=e["question"], answer=e["answer"]))
    return F.array_join(texts, "")


def chat(system: Column | None, user: Column, developer: Column | None = None) -> Column:
    """The messages of a request: system and developer if given, then the user's."""
    said = [("system", system), ("developer", developer), ("user", user)]
    return F.array(*[F.struct(F.lit(r).alias("from"), c.alias("value")) for r, c in said if c is not None])


def with_tokens(df: DataFrame, text: str, most: int, encode: Callable[[str], list] | None = None) -> DataFrame:
    """Add ``tokens`` and ``long`` (more than three quarters of ``most``); no row is dropped. Without ``encode`` words are
    counted; with it, texts go to Python in Arrow batches."""
    if encode is None:
        tokens = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    else:

        @F.pandas_udf("long")
        def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield texts.map(lambda t: len(encode(t or "")), na_action=None).astype("int64")

        tokens = count(F.col(text))
    return df.withColumn("tokens", tokens).withColumn("long", F.col("tokens") * 4 > 3 * most)
