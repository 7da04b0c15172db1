"""Training mixtures as a configuration describes them: chat, completion and preference datasets become one table."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.templates import TEMPLATES, pieces
from chatloom.functions.turns import map_roles, turn
from chatloom.operators.datasets import smallest
from chatloom.operators.packing import pack
from chatloom.operators.tokens import RANKS, with_token_masks
from chatloom.sources.jsonl import read_lines
from chatloom.sources.scratch import scratch_dir

# The keys of a dataset and the kinds there are; other keys are errors, as a misspelled one would be ignored else.
KINDS = {"chat_template": "chat", "axolotl.integrations.kd.chat_template": "chat", "completion": "completion", "user_defined.default": "preference", "custom": "prompt"}
COMMON = ("path", "ds_type", "type")
KEYS = {
    "chat": ("field_messages", "message_property_mappings", "roles", "logprobs_field", "temperature"),
    "completion": ("field",),
    "preference": ("field_prompt", "field_chosen", "field_rejected"),
    "prompt": ("field_prompt",),
}
COLUMNS = "dataset pos line_no kind conversations text prompt chosen rejected logprobs".split()


@dataclass(frozen=True)
class Source:
    path: str
    kind: str
    #: Name in the table to name in the file.
    fields: dict[str, str]
    roles: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Mixture:
    sources: tuple[Source, ...]
    context: int = 8192
    packing: bool = False
    train_on_inputs: bool = False
    shuffle: bool = True
    #: Rows kept back for validation: a share below 1, or a number of rows.
    validation: float = 0.0
    template: str = "chatml"


def substitute(text: str, variables: dict[str, str]) -> str:
    """$NAME and ${NAME} by their values; a name without one is an error, and $$ is a dollar."""

    def value(m: re.Match) -> str:
        if m[0] == "$$":
            return "$"
        name = m[1] or m[2]
        if name not in variables:
            raise KeyError(f"no value for ${name}")
        return variables[name]

    return re.sub(r"\$\$|\$(?:\{(\w+)\}|(\w+))", value, text)


def load(spark: SparkSession, path: str, variables: dict[str, str]) -> Mixture:
    """The mixture of a YAML file; variables are put in first."""
    import yaml  # beside Spark this is the only thing that needs it

    (row,) = spark.read.text(path, wholetext=True).collect()
    return compile_mixture(yaml.safe_load(substitute(row.value, variables)))


def compile_mixture(config: dict) -> Mixture:
    """The parts of a configuration that concern data. Keys of the training itself are left alone, unknown ones of a dataset
    are errors, and so are two roles with one alias."""
    sources = tuple(_source(d, i) for i, d in enumerate(config.get("datasets") or []))
    if not sources:
        raise ValueError("a mixture needs datasets")
    return Mixture(
        sources,
        context=int(config.get("sequence_len", Mixture.context)),
        packing=bool(config.get("sample_packing", Mixture.packing)),
        train_on_inputs=bool(config.get("train_on_inputs", Mixture.train_on_inputs)),
        shuffle=bool(config.get("shuffle_merged_datasets", Mixture.shuffle)),
        validation=float(config.get("val_set_size") or 0),
        template=_template(config.get("chat_template", Mixture.template)),
    )


def _template(name: str) -> str:
    if name not in TEMPLATES:
        raise ValueError(f"chat_template {name!r}: one of {', '.join(sorted(TEMPLATES))}")
    return name


def _source(d: dict, at: int) -> Source:
    kind = KINDS.get(d.get("type"))
    if kind is None or d.get("ds_type", "json") != "json" or not d.get("path"):
        raise ValueError(f"dataset {at}: type {d.get('type')!r}, ds_type {d.get('ds_type')!r}, path {d.get('path')!r}")
    if unknown := sorted(set(d) - {*COMMON, *KEYS[kind]}):
        raise ValueError(f"dataset {at}: unknown keys {', '.join(unknown)}")
    if kind == "completion":
        return Source(d["path"], kind, {"text": d.get("field", "text")})
    if kind == "preference":
        return Source(d["path"], kind, {n: d.get(f"field_{n}", n) for n in ("prompt", "chosen", "rejected")})
    if kind == "prompt":
        return Source(d["path"], kind, {"prompt": d.get("field_prompt", "prompt")})
    named = d.get("message_property_mappings") or {}
    if unknown := sorted(set(named) - {"role", "content"}):
        raise ValueError(f"dataset {at}: unknown message properties {', '.join(unknown)}")
    roles: dict[str, str] = {}
    for name, aliases in (d.get("roles") or {}).items():
        for alias in aliases:
            if roles.setdefault(alias, name) != name:
                raise ValueError(f"dataset {at}: {alias} is {roles[alias]} and {name}")
    fields = {"messages": d.get("field_messages", "messages"), "role": named.get("role", "role"), "content": named.get("content", "content")}
    if "logprobs_field" in d:
        fields["logprobs"] = d["logprobs_field"]
    return Source(d["path"], kind, fields, roles)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_source(spark: SparkSession, source: Source, at: int) -> DataFrame:
    """COLUMNS of one dataset's non-blank lines; a bad line fails. Columns of other kinds are null."""
    f = source.fields
    if source.kind == "chat":
        schema = f"{_quoted(f['messages'])} array<struct<{_quoted(f['role'])}:string,{_quoted(f['content'])}:string>>"
        schema += f", {_quoted(f['logprobs'])} string" if "logprobs" in f else ""  # as JSON, whatever it holds
    else:
        schema = ", ".join(f"{_quoted(n)} string" for n in dict.fromkeys(f.values()))
    lines = read_lines(spark, source.path).filter(F.trim("raw") != "")
    row = F.from_json("raw", schema, {"mode": "FAILFAST"})
    lines = lines.withColumn("row", row)

    def text(name: str) -> Column:
        return F.col("row").getField(f[name]) if name in f else F.lit(None).cast("string")

    if source.kind == "chat":
        turns = F.transform(F.col("row").getField(f["messages"]), lambda m: turn(m.getField(f["role"]), m.getField(f["content"])))
        turns = map_roles(turns, {a: n for a, n in source.roles.items() if a != n})
    else:
        turns = F.lit(None).cast("array<struct<`from`:string,value:string>>")
    values = {"dataset": F.lit(source.path), "pos": F.lit(at), "line_no": F.col("line_no"), "kind": F.lit(source.kind), "conversations": turns}
    return lines.select(*[v.alias(n) for n, v in values.items()], *[text(n).alias(n) for n in COLUMNS[5:]])


def read_mixture(spark: SparkSession, mixture: Mixture) -> DataFrame:
    """All datasets in one table (COLUMNS), repeated as often as the configuration names them. Its order is that of nothing;
    ``shuffle_key`` puts the rows in the order of a seed."""
    return reduce(DataFrame.unionByName, [read_source(spark, s, i) for i, s in enumerate(mixture.sources)])


def shuffle_key(seed: int = 42) -> Column:
    return F.xxhash64(F.lit(seed), "pos", "dataset", "line_no")


def split_validation(rows: DataFrame, mixture: Mixture, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(training, validation) rows of a mixture: exactly the share or number of rows that it keeps back, by a seeded hash."""
    total = rows.count()
    n = round(total * mixture.validation) if mixture.validation < 1 else int(mixture.validation)
    if n >= total > 0:
        raise ValueError(f"{n} rows for validation, of {total}")
    place = F.concat_ws(":", "pos", "dataset", "line_no")
    named = rows.withColumn("place_", place).withColumnRenamed("chosen", "answer_")  # chosen is what smallest adds
    marked = smallest(named, F.xxhash64(F.lit(seed), place).bitwiseAND(F.lit(0xFFFFFFFF)), n, "place_")
    back = [F.col("answer_").alias(c) if c == "chosen" else F.col(c) for c in rows.columns]
    return marked.filter("NOT chosen").select(*back), marked.filter("chosen").select(*back)


def training_rows(spark: SparkSession, mixture: Mixture, ranks: str = RANKS, seed: int = 42, special: dict[str, int] | None = None) -> DataFrame:
    """COLUMNS plus token_ids, token_loss, tokens, pack, begin: what the trainer reads. Chat rows have loss on assistant turns
    (everywhere with train_on_inputs), completions on all tokens, preferences on what was chosen, prompts nowhere. Rows longer than the
    context have no pack; without sample packing every other row is a pack of its own. Empty rows have none. ``special`` has the
    ids of the template's markers; without them their characters are tokens like any text. With sample packing the rows and
    their tokens are written to the scratch folder once, as the plan of the packs needs all lengths first."""
    # A dataset named again is read and tokenised with its first naming.
    first = [mixture.sources.index(s) for s in mixture.sources]
    rows = reduce(DataFrame.unionByName, [read_source(spark, mixture.sources[i], i) for i in sorted(set(first))])
    named = F.create_map(*[c for i in sorted(set(first)) for c in (F.lit(i), F.array(*[F.lit(k) for k, f in enumerate(first) if f == i]))])

    def piece(c: str, loss: bool) -> Column:
        return F.struct(F.coalesce(F.col(c), F.lit("")).alias("text"), F.lit(loss or mixture.train_on_inputs).alias("loss"), F.lit(False).alias("own"))

    chat = F.when(F.size("conversations") > 0, pieces(TEMPLATES[mixture.template], F.col("conversations")))
    if mixture.train_on_inputs:
        chat = F.transform(chat, lambda p: F.struct(p["text"].alias("text"), F.lit(True).alias("loss"), p["own"].alias("own")))
    other = F.when(F.col("kind") == "completion", F.array(piece("text", True))).otherwise(F.array(piece("prompt", False), piece("chosen", True)))
    rows = with_token_masks(rows.withColumn("pieces", F.when(F.col("kind") == "chat", chat).otherwise(other)), "pieces", ranks, special).drop("pieces")
    rows = rows.withColumn("pos", F.explode(F.element_at(named, F.col("pos"))))
    key = ["pos", "dataset", "line_no"]
    if mixture.packing:
        path = f"{scratch_dir(spark)}/chatloom-{uuid.uuid4().hex}"
        rows = rows.withColumns({"tokens": F.size("token_ids").cast("long"), "row_": F.monotonically_increasing_id()})
        rows.write.option("compression", "zstd").parquet(path)
        rows = spark.read.schema(rows.schema).parquet(path)
        # Packs are planned over keys and lengths; a key may repeat, as line numbers are those of one file.
        places = pack(rows.select(*key, "row_", "tokens"), key, F.col("tokens"), mixture.context, seed)
        return rows.join(places.select("row_", "pack", "begin"), "row_").select(*COLUMNS, "token_ids", "token_loss", "pack", "begin", "tokens")
    n = F.size("token_ids").cast("long")
    fits = n.between(1, mixture.context)
    return rows.withColumns({"pack": F.when(fits, F.xxhash64(F.lit(seed), *key)), "begin": F.when(fits, F.lit(0).cast("long")), "tokens": n})
