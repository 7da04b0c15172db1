"""License scans: rolling word n-gram hashes joined with the places of license texts, voting for the offset between the two.

A document word at place i that begins the template's n-gram at place j votes for the diagonal i - j. Votes are summed by
diagonal, neighbouring diagonals (words put in or left out) merge to a span, and what a span really shares with its
template, word for word, decides. All of it is column expressions and joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import text_or_empty

# The phrases that count as such, with their labels.
PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]
# Notices of public licenses, as their stewards ask to print them.
NOTICES = [
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"),
    ("mit", "released under the mit license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
]
#: Words of an n-gram; templates of fewer words use grams of SHORT words.
GRAM, SHORT = 4, 2
#: A span merges diagonals this far apart.
SLACK = 3
#: Share of a template's words that a span must have.
LEAST_SHARE = 0.6
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _with_grams(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` plus words, pairs and fours: the words and, for each place, the hash of the two and four words from there.
    A hash of two is made of those of its words, one of four of two pairs."""
    words = F.array_remove(F.split(F.translate(text, UPPER, LOWER), NOT_WORD), "")
    rows = rows.withColumn("words", words).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    later = lambda name, by: F.slice(name, by + 1, F.greatest(F.size(name) - by, F.lit(0)))
    both = lambda a, b: F.xxhash64(a, b)
    rows = rows.withColumn("pairs", F.zip_with("hashes", later("hashes", 1), both))
    return rows.withColumn("fours", F.zip_with("pairs", later("pairs", 2), both)).drop("hashes")


def template_places(spark: SparkSession, templates: list[tuple[str, str, bool]]) -> DataFrame:
    """(template, label, base, size, k, place, hash, gram) for each place of each template: as many rows as the templates
    have words, which is what the scan broadcasts."""
    listed = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(name).alias("label"), F.lit(base).alias("base"), F.lit(text).alias("text")) for i, (name, text, base) in enumerate(templates)])
    rows = _with_grams(spark.range(1).select(F.explode(listed).alias("t")).select("t.*"), F.col("text"))
    size = F.size("words")
    long = size >= GRAM
    k = F.when(long, GRAM).otherwise(SHORT)
    rows = rows.select("template", "label", "base", size.alias("size"), k.alias("k"), "words", F.posexplode(F.when(long, F.col("fours")).otherwise(F.col("pairs"))).alias("place", "hash"))
    whole = rows.filter(F.col("place") <= F.col("size") - F.col("k"))
    return whole.withColumn("gram", F.expr("slice(words, place + 1, k)")).drop("words")


def _places(docs: DataFrame, templates: list[tuple[str, str, bool]]) -> DataFrame:
    """(row, doc_id, n_words, template, label, base, size, k, diagonal, places) for each diagonal with votes, and one row with a null
    template per document. The row number keeps documents apart that share an id."""
    rows = _with_grams(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_or_empty().alias("text")), F.col("text")).drop("text")
    n = F.size("words")
    # A first element that is no hash stands for the document itself.
    rows = rows.select("row", "doc_id", n.alias("n_words"), "words", F.posexplode(F.concat(F.array(F.lit(None).cast("long")), "pairs", "fours")).alias("at", "hash"))
    # pairs and fours have one element per word each, so the places of either follow from the element's number.
    rows = rows.withColumns({"place_": F.when(F.col("at") > 0, (F.col("at") - 1) % F.col("n_words")), "k_": F.when(F.col("at") > F.col("n_words"), GRAM).otherwise(SHORT)})
    t = F.broadcast(template_places(docs.sparkSession, templates))
    same = (rows["hash"] == t["hash"]) & (rows["k_"] == t["k"]) & (F.expr("slice(words, place_ + 1, k_)") == t["gram"])
    votes = rows.join(t, same, "left").filter("template IS NOT NULL OR at = 0")
    of = ["row", "doc_id", "n_words", "template", "label", "base", "size", "k"]
    return votes.select(*of, (F.col("place_") - F.col("place")).alias("diagonal"), "place").groupBy(*of, "diagonal").agg(F.collect_set("place").alias("places"))


def license_spans(docs: DataFrame, templates: list[tuple[str, str, bool]] | None = None, slack: int = SLACK) -> DataFrame:
    """(row, doc_id, n_words, template, label, base, first_word, share) for each span: ``share`` of the template's words stand there as
    in the template, in runs of an n-gram at least. Documents without any have one row with a null template."""
    found = _places(docs, templates or default_templates())
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    # Phrases count place by place, and short templates must not swallow the next one.
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > F.when(F.col("base"), 0).otherwise(F.least(F.lit(slack), F.floor(F.col("size") / 4)))
    span = F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(order)
    of = ["row", "doc_id", "n_words", "template", "label", "base", "size", "k"]
    merged = found.withColumn("span", span).groupBy(*of, "span").agg(F.min("diagonal").alias("first_word"), F.flatten(F.collect_list("places")).alias("places"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("k") - 1)))))
    return merged.select("row", "doc_id", "n_words", "template", "label", "base", "first_word", (covered / F.col("size")).alias("share"))


def default_templates() -> list[tuple[str, str, bool]]:
    return [(name, text, True) for name, text in PHRASES] + [(name, text, False) for name, text in NOTICES]


def license_report(docs: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """One row per document: doc_id, n_words, n_base (places of phrases), first_word and last_word (the first and last of
    them), base_labels, labels (phrases and spans with ``least_share`` of a notice), score (the best share of any span,
    0 without one). Null text is empty and has no words; repeated rows are told each; other columns are ignored."""
    spans = license_spans(docs)
    base = F.coalesce("base", F.lit(False))
    names = lambda keep: F.array_join(F.array_sort(F.collect_set(F.when(keep, F.col("label")))), ",")
    told = spans.groupBy("row", "doc_id", "n_words").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).cast("long").alias("last_word"),
        names(base).alias("base_labels"),
        names(base | (F.col("share") >= least_share)).alias("labels"),
        F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
    )
    return told.select("doc_id", F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")
