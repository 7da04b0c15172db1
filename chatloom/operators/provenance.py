"""Rows that refer to lines of source files, and rows brought to a fixed set of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.strings import strip
from chatloom.operators import open_keys as K
from chatloom.sources.jsonl import classify_lines

# The keys of the two target schemas.
TARGET = ("conversations", "distilled_model", "distilled_source_index", "distilled_source_path", "distilled_timestamp_utc", "id", "label_agreement")
TARGET_WITH_LOGPROBS = (*TARGET, "distilled_token_logprobs")


def references(lines: DataFrame) -> DataFrame:
    """Add source_path, source_index and ``reject`` (blank, invalid, non_object, source_path, source_index; null for a row that
    refers to a line) to lines with ``raw``. A rejected row has no reference."""
    row = K.entries(F.col("raw"))
    of = classify_lines(lines).withColumn("reject", F.when(F.col("reject") != "no_conversations", F.col("reject")))
    path = K.string_of(F.try_element_at(row, F.lit("distilled_source_path")))
    of = of.withColumns({"source_path": path, "source_index": K.integer_of(F.try_element_at(row, F.lit("distilled_source_index")))})
    no_path = F.coalesce(strip(F.col("source_path")) == "", F.lit(True))
    reject = F.when(F.col("reject").isNotNull(), F.col("reject")).when(no_path, "source_path").when(F.col("source_index").isNull(), "source_index")
    of = of.withColumn("reject", reject)
    return of.withColumns({c: F.when(F.col("reject").isNull(), F.col(c)) for c in ("source_path", "source_index")})


def wanted_lines(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """The lines (path, line_no, raw) that ``wanted`` (path, line_no) asks for and that are not blank."""
    return lines.filter(F.trim("raw") != "").join(wanted.select("path", "line_no"), ["path", "line_no"], "left_semi")


def lookup_stats(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """path, requested (distinct lines), found, missing (no such file), one row per file asked for."""
    requested = wanted.select("path", "line_no").distinct().groupBy("path").agg(F.count("*").alias("requested"))
    found = wanted_lines(lines, wanted).groupBy("path").agg(F.count("*").alias("found"))
    files = lines.select("path").distinct().withColumn("there", F.lit(True))
    joined = requested.join(found, "path", "left").join(files, "path", "left")
    return joined.select("path", "requested", F.coalesce("found", F.lit(0).cast("long")).alias("found"), F.col("there").isNull().alias("missing"))


def row_id(row: Column, line_no: Column) -> Column:
    """The first of id, question_id and answer_id that is a string and not blank; else file name and index of the source; else
    the line's number, from 1, which ``line_no`` gives."""
    own = lambda k: K.string_of(F.try_element_at(row, F.lit(k)))
    named = [F.when(strip(own(k)) != "", own(k)) for k in ("id", "question_id", "answer_id")]
    index = F.try_element_at(row, F.lit("distilled_source_index"))
    name = F.nullif(F.regexp_extract(own("distilled_source_path"), r"([^/]+)/*\z", 1), F.lit(""))
    source = F.when(index.rlike(r"^-?[0-9]+\z"), F.concat(name, F.lit(":"), index))
    return F.coalesce(*named, source, F.concat(F.lit("line:"), line_no.cast("string")))


def to_target(row: Column, line_no: Column, keys: tuple = TARGET) -> Column:
    """``row`` (JSON texts by key) with the target's keys alone: null where it has none, an id always, and unknown for an
    agreement that is no text."""
    agreed = K.string_of(F.try_element_at(row, F.lit("label_agreement")))
    fixed = {"id": row_id(row, line_no), "label_agreement": F.when(strip(agreed) != "", agreed).otherwise("unknown")}
    value = lambda k: K.quoted(fixed[k]) if k in fixed else F.coalesce(F.try_element_at(row, F.lit(k)), F.lit("null"))
    return F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[value(k) for k in keys]))
