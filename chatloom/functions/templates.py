"""Chat templates as column expressions: what a model's tokenizer makes of a conversation, without leaving the JVM."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions.strings import strip
from chatloom.functions.turns import turn

TURNS = "array<struct<`from`:string,value:string>>"
PIECES = "array<struct<text:string,loss:boolean,own:boolean>>"


@dataclass(frozen=True)
class ChatTemplate:
    """``before`` and ``after`` a turn's text, where {role} is its name there. ``system`` tells where the system's text goes: into
    a turn of its own, or ahead of the first user's text, apart by an empty line. ``last`` ends the last turn in place of ``after``
    if it is the assistant's."""

    before: str
    after: str
    begin: str = ""
    names: dict[str, str] = field(default_factory=dict)
    #: Openings of single roles in place of ``before``.
    opening: dict[str, str] = field(default_factory=dict)
    last: str | None = None
    system: str = "turn"
    default_system: str | None = None
    trim: bool = False


# How public model families mark turns.
TEMPLATES = {
    "chatml": ChatTemplate("<|im_start|>{role}\n", "<|im_end|>\n"),
    "qwen_25": ChatTemplate("<|im_start|>{role}\n", "<|im_end|>\n", default_system="You are Qwen, created by Alibaba Cloud. You are a helpful assistant."),
    "llama3": ChatTemplate("<|start_header_id|>{role}<|end_header_id|>\n\n", "<|eot_id|>", begin="<|begin_of_text|>", trim=True),
    "gemma": ChatTemplate("<start_of_turn>{role}\n", "<end_of_turn>\n", begin="<bos>", names={"assistant": "model"}, system="first_user", trim=True),
    "harmony": ChatTemplate("<|start|>{role}<|message|>", "<|end|>", opening={"assistant": "<|start|>assistant<|channel|>final<|message|>"}, last="<|return|>"),
}


def _opening(template: ChatTemplate, role: Column) -> Column:
    name = role
    for old, new in template.names.items():
        name = F.when(role == old, F.lit(new)).otherwise(name)
    first, _, second = template.before.partition("{role}")
    out = F.concat(F.lit(first), name, F.lit(second))
    for of, text in template.opening.items():
        out = F.when(role == of, F.lit(text)).otherwise(out)
    return out


def _turns(template: ChatTemplate, conv: Column) -> Column:
    """The turns as the template shows them: nulls as empty texts, system texts where they belong."""
    said = F.transform(conv, lambda t: turn(F.coalesce(t["from"], F.lit("")), (strip if template.trim else lambda c: c)(F.coalesce(t["value"], F.lit("")))))
    is_system = lambda t: t["from"] == "system"
    if template.default_system is not None:
        own = F.array(turn(F.lit("system"), F.lit(template.default_system)))
        said = F.when((F.size(said) > 0) & ~F.exists(said, is_system), F.concat(own, said)).otherwise(said)
    if template.system == "turn":
        return said
    # Bound once: the conversation without system turns, and the first system text.
    both = F.array(F.struct(F.filter(said, lambda t: ~is_system(t)).alias("rest"), F.get(F.filter(said, is_system), F.lit(0))["value"].alias("system")))

    def merged(x: Column) -> Column:
        at = F.array_position(F.transform(x["rest"], lambda t: t["from"]), "user") - 1
        with_system = lambda t, i: turn(t["from"], F.when((i == at) & x["system"].isNotNull(), F.concat(x["system"], F.lit("\n\n"), t["value"])).otherwise(t["value"]))
        return F.transform(x["rest"], with_system)

    return F.get(F.transform(both, merged), F.lit(0))


def pieces(template: ChatTemplate, conv: Column, train: tuple[str, ...] = ("assistant",)) -> Column:
    """array<struct<text, loss, own>> of a conversation (array<struct<from, value>>): the beginning, then each turn's opening, its
    text and its end; ``own`` are the template's own parts, whose markers are tokens of their own to a model. Loss is on the texts of the roles in ``train`` and on the ends behind them, from which a model learns to
    stop. A null or empty conversation is the beginning alone."""
    turns = F.array(F.coalesce(_turns(template, conv), F.array().cast(TURNS)))

    def of_turns(ts: Column) -> Column:
        def three(t: Column, i: Column) -> Column:
            loss = t["from"].isin(*train)
            end = F.lit(template.after)
            if template.last is not None:
                end = F.when((i == F.size(ts) - 1) & (t["from"] == "assistant"), F.lit(template.last)).otherwise(end)
            parts = [(_opening(template, t["from"]), F.lit(False), True), (t["value"], loss, False), (end, loss, True)]
            return F.array(*[F.struct(x.alias("text"), y.alias("loss"), F.lit(own).alias("own")) for x, y, own in parts])

        return F.flatten(F.transform(ts, three)).cast(PIECES)

    begin = F.array(F.struct(F.lit(template.begin).alias("text"), F.lit(False).alias("loss"), F.lit(True).alias("own"))) if template.begin else F.array()
    return F.concat(begin.cast(PIECES), F.get(F.transform(turns, of_turns), F.lit(0)))


def render(template: ChatTemplate, conv: Column, generate: bool = False) -> Column:
    """The text of a conversation; with ``generate`` the assistant's opening stands behind it, for a model to go on."""
    text = F.array_join(F.transform(pieces(template, conv), lambda p: p["text"]), "")
    return F.concat(text, _opening(template, F.lit("assistant"))) if generate else text
