"""Functions on ``conversations``: array<struct<from: string, value: string>>."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ROLE_ALIASES = {"human": "user", "gpt": "assistant", "model": "assistant"}


def _places(conv: Column, test: Callable[[Column], Column]) -> Column:
    at = F.transform(conv, lambda t, i: F.when(test(t["from"]), i))
    return F.filter(at, lambda i: i.isNotNull())


def user_index(conv: Column) -> Column:
    return F.array_min(_places(conv, lambda r: r.isin("human", "user")))


def assistant_index(conv: Column) -> Column:
    """The first assistant turn after the first user turn."""
    user = user_index(conv)
    return F.array_min(F.filter(_places(conv, lambda r: r == "assistant"), lambda i: i > user))


def system_index(conv: Column) -> Column:
    """The first system turn, unless the assistant's answer comes before it."""
    first, asst = F.array_min(_places(conv, lambda r: r == "system")), assistant_index(conv)
    return F.when(asst.isNull() | (first < asst), first)


def drop_system(conv: Column) -> Column:
    """A turn without a role is kept."""
    return F.filter(conv, lambda t: ~t["from"].eqNullSafe(F.lit("system")))


def turn(role: Column, value: Column) -> Column:
    return F.struct(role.alias("from"), value.alias("value"))


def set_value(conv: Column, index: Column, value: Column) -> Column:
    return F.transform(conv, lambda t, i: turn(t["from"], F.when(i == index, value).otherwise(t["value"])))


def answer_with(conv: Column, value: Column) -> Column:
    """Overwrite the assistant's answer, or append one."""
    at = assistant_index(conv)
    return F.when(at.isNotNull(), set_value(conv, at, value)).otherwise(F.concat(conv, F.array(turn(F.lit("assistant"), value))))


def _assistant_like(role: Column) -> Column:
    return F.coalesce(F.lower(F.trim(role)).isin("assistant", "gpt", "model"), F.lit(False))


def rewrite_assistants(conv: Column, value: Column) -> Column:
    new = F.transform(conv, lambda t: F.when(_assistant_like(t["from"]), turn(F.lit("assistant"), value)).otherwise(t))
    return F.when(F.exists(conv, lambda t: _assistant_like(t["from"])), new).otherwise(F.concat(conv, F.array(turn(F.lit("assistant"), value))))


def first_assistant_text(conv: Column) -> Column:
    """What the first assistant-like turn says; empty without one."""
    said = F.transform(F.filter(conv, lambda t: _assistant_like(t["from"])), lambda t: t["value"])
    return F.coalesce(F.get(said, F.lit(0)), F.lit(""))


def set_system(conv: Column, value: Column) -> Column:
    """Overwrite the system turn before the answer; a conversation without one stays."""
    at = system_index(conv)
    return F.when(at.isNotNull(), set_value(conv, at, value)).otherwise(conv)


def asked(question: Column, answer: Column, user: str = "user") -> Column:
    """A conversation of one question and its answer."""
    return F.array(turn(F.lit(user), question), turn(F.lit("assistant"), answer))


def first_value(conv: Column, index: Column) -> Column:
    """The text at a place that may be null."""
    return F.get(F.transform(conv, lambda t: t["value"]), index)


def map_assistants(conv: Column, change: Callable[[Column], Column]) -> Column:
    return F.transform(conv, lambda t: turn(t["from"], F.when(_assistant_like(t["from"]), change(t["value"])).otherwise(t["value"])))


def map_with_status(conv: Column, change: Callable[[Column], Column], status: Callable[[Column], Column]) -> Column:
    """struct<conversations, status>: all assistant turns changed, and the status of the last one's text; no_assistant_turn
    without one, no_conversations for null. A null text counts as the text None."""
    said = lambda v: F.coalesce(v, F.lit("None"))
    found = F.transform(F.filter(conv, lambda t: _assistant_like(t["from"])), lambda t: status(said(t["value"])))
    told = F.when(conv.isNull(), "no_conversations").otherwise(F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit("no_assistant_turn")))
    return F.struct(map_assistants(conv, lambda v: change(said(v))).alias("conversations"), told.alias("status"))


def map_roles(conv: Column, aliases: dict[str, str] = ROLE_ALIASES) -> Column:
    def name(role: Column) -> Column:
        out = role
        for old, new in aliases.items():
            out = F.when(role == old, F.lit(new)).otherwise(out)
        return out

    return F.transform(conv, lambda t: turn(name(t["from"]), t["value"]))


def from_messages(messages: Column) -> Column:
    """role/content turns as from/value turns."""
    return F.transform(messages, lambda m: turn(m["role"], m["content"]))


def loss_mask(conv: Column) -> Column:
    return F.transform(conv, lambda t: _assistant_like(t["from"]))
