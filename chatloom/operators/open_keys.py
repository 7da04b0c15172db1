"""Label-like entries of open JSON rows, merged into other rows with counts. Values are JSON texts, so types survive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions.strings import non_empty, strip

# Keys that describe a row itself, and what the name of a label-like key holds.
SKIP = (
    "conversations", "id", "split", "question_type", "task", "label_agreement", "distilled_model", "distilled_source_index",
    "distilled_source_path", "distilled_timestamp_utc", "distilled_prompt_used", "distilled_finish_reason", "distilled_error",
)
#: Label keys that come first, in this order.
CORE = (
    "true_label", "true_answer_text", "true_label_idx", "true_rationale", "label", "answer", "answer_id", "source_answer_idx", "has_label", "label_type",
    "label_match_mode", "label_join_status", "label_source_split",
)
#: Fields that condensing leaves out.
ORIGINAL = (
    "answer_id", "question_id", "question_type", "split", "task", "true_label", "true_label_abc", "true_label_idx", "true_answer_text", "true_rationale",
    "source_answer_idx", "label_type", "has_label", "label_match_mode", "label_join_status",
)
LABEL_LIKE = r"(?i)(label|answer|rationale|target|gold|correct)"


def entries(raw: Column) -> Column:
    """A JSON object as map<string, string> of JSON texts; empty for anything else."""
    found = F.transform_values(F.from_json(raw, "map<string,variant>"), lambda _, v: F.coalesce(F.to_json(v), F.lit("null")))
    return F.coalesce(found, F.create_map().cast("map<string,string>"))


def says_something(json: Column) -> Column:
    """False for null, blank, none, null and nan strings; true for 0, false and empty lists."""
    said = F.try_variant_get(F.try_parse_json(json), "$", "string")
    empty = json.isNull() | (json == "null") | (json.startswith('"') & non_empty(said).isNull())
    return ~empty


def string_of(json: Column) -> Column:
    """The text of a JSON string; null for any other JSON."""
    return F.when(json.startswith('"'), F.try_variant_get(F.try_parse_json(json), "$", "string"))


def integer_of(json: Column) -> Column:
    """A whole number from a JSON text: numbers lose their fraction, true is 1, strings may have blanks around them and
    underscores between digits; null for what is no whole number then."""
    said = strip(string_of(json))
    digits = F.when(said.rlike(r"^[+-]?[0-9]+(_[0-9]+)*\z"), F.replace(said, F.lit("_"), F.lit("")))
    number = F.coalesce(json.try_cast("long"), json.try_cast("double").try_cast("long"))
    return F.when(json.startswith('"'), digits.try_cast("long")).when(json == "true", 1).when(json == "false", 0).otherwise(number)


def id_text(raw: Column) -> Column:
    """The key ``id`` of a JSON object as text: numbers as they are written, null as None, booleans as True and False;
    null if there is no such key."""
    there = F.array_contains(F.json_object_keys(raw), "id")
    said = F.get_json_object(raw, "$.id")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(raw), "$.id", "variant"))
    word = F.when(kind == "BOOLEAN", F.initcap(said)).otherwise(F.coalesce(F.from_json(raw, "id string")["id"], F.lit("None")))
    return F.when(there, word)


def pick_answer(row: Column, preferred: str = "") -> Column:
    """The first string, be it empty, under the preferred key, distilled_answer, or distilled_answer_* in order of the
    keys; empty if there is none."""
    own = lambda k: string_of(F.try_element_at(row, F.lit(k)))
    named = F.array_sort(F.map_entries(F.map_filter(row, lambda k, _: k.startswith("distilled_answer_"))))
    strings = F.filter(F.transform(named, lambda e: string_of(e["value"])), lambda x: x.isNotNull())
    return F.coalesce(own(preferred), own("distilled_answer"), F.get(strings, F.lit(0)), F.lit(""))


def labels_of(row: Column) -> Column:
    return F.map_filter(row, lambda k, v: ~k.isin(*SKIP) & k.rlike(LABEL_LIKE) & says_something(v))


def without(row: Column, keys: tuple = ORIGINAL) -> Column:
    return F.map_filter(row, lambda k, _: ~k.isin(*keys))


def all_but_skipped(row: Column) -> Column:
    return F.map_filter(row, lambda k, _: ~k.isin(*SKIP))


def put(row: Column, new: Column) -> Column:
    """``row`` with the entries of ``new`` over its own."""
    return F.map_concat(F.map_filter(row, lambda k, _: ~F.map_contains_key(new, k)), new)


def merge(row: Column, copied: Column, keep_existing: bool = False) -> dict[str, Column]:
    """The merged row, how many keys it lacked, and how many of its values that said something else went."""
    own = lambda k: F.try_element_at(row, k)
    if keep_existing:
        copied = F.map_filter(copied, lambda k, _: ~says_something(own(k)))
    added = F.map_filter(copied, lambda k, _: ~F.map_contains_key(row, k))
    changed = F.map_filter(copied, lambda k, v: says_something(own(k)) & (own(k) != v))
    return {"merged": put(row, copied), "added": F.size(added).cast("long"), "overwritten": F.size(changed).cast("long")}


def quoted(text: Column) -> Column:
    """A text as a JSON string."""
    j = F.to_json(F.array(text))
    return F.substring(j, F.lit(2), F.length(j) - 2)


def embed(row: Column, source_raw: Column, payload: bool = True, raw: bool = True) -> Column:
    """The source row as an object, as its exact text, or both."""
    if payload:
        row = put(row, F.create_map(F.lit("source_row_payload"), source_raw))
    if raw:
        row = put(row, F.create_map(F.lit("source_row_raw_json"), quoted(source_raw)))
    return row


def to_line(row: Column, first: tuple = ()) -> Column:
    """The entries as one JSON object: the keys in ``first`` as listed there, then the others in order."""
    entries_ = F.map_entries(row)
    if first:
        place = lambda k: F.array_position(F.array(*[F.lit(x) for x in first]), k)
        ranked = F.transform(entries_, lambda e: F.struct(F.when(place(e["key"]) > 0, place(e["key"])).otherwise(len(first) + 1).alias("at"), e["key"].alias("key"), e["value"].alias("value")))
    else:
        ranked = entries_
    parts = F.transform(F.array_sort(ranked), lambda e: F.concat(quoted(e["key"]), F.lit(":"), e["value"]))
    return F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))
