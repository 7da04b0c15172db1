"""Chat formatting into budgeted windows.

A conversation becomes windows of whole turns. Prefix sums of the turns' tokens choose the spans: a window's own turns
lie within one stretch of the room that the budget leaves, and a turn that crosses from one stretch to the next gets a
window of its own. Every window repeats the system turn and a little history; repeated turns carry another mark and no
loss, so each assistant text is a target once. Long conversations are cut into blocks of turns first, and the turns that
the next block needs as history are handed over, so no conversation is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import text_or_empty, word_count

BUDGET = 1024  # tokens of a window
HISTORY = 192  # of these, for repeated turns besides the system turn
HISTORY_TURNS = 2
BLOCK = 2048  # turns of a conversation that are laid out together
TURN_TOKENS = 4  # marks around a turn

# The template's control strings. Texts that hold one of them, or one of the common control strings
# <s> </s> [INST] [/INST], get a backslash after its first character; backslashes of the text itself are doubled.
START, AGAIN, END = "<|start|>", "<|again|>", "<|end|>\n"
_ESCAPE = r"<(?=\||/?s>)|\[(?=/?INST\])"
_UNESCAPE = r"([<\[])\\(?=\||/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _ESCAPE, r"$0\\")


def unescape(text: Column) -> Column:
    return F.replace(F.regexp_replace(text, _UNESCAPE, "$1"), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n>"))


def unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(role, r"<\\n>", "\n"))


def _with_handed_over(turns: DataFrame, block: int, history_turns: int) -> DataFrame:
    """Turns with their block and ``own``; the last turns of a block, and the first system turn, also go to later blocks."""
    t = turns.withColumn("block", F.expr(f"turn div {block}"))
    here = F.struct("block", F.lit(True).alias("own"))
    on = F.struct((F.col("block") + 1).alias("block"), F.lit(False).alias("own"))
    last = F.pmod("turn", F.lit(block)) >= block - history_turns
    moved = t.withColumn("to", F.explode(F.when(last, F.array(here, on)).otherwise(F.array(here))))
    moved = moved.select("conv_id", "turn", "role", "text", "tokens", F.col("to.block").alias("block"), F.col("to.own").alias("own"))
    first = t.filter("role = 'system'").groupBy("conv_id").agg(F.min(F.struct("turn", "block", "text", "tokens")).alias("sys"))
    later = t.filter("block <> 0").select(F.col("conv_id").alias("c"), F.col("block").alias("b")).distinct()
    system = later.join(first, F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("b") > F.col("sys.block"))).select(
        "conv_id", "sys.turn", F.lit("system").alias("role"), "sys.text", "sys.tokens", F.col("b").alias("block"), F.lit(False).alias("own")
    )
    # A system turn among the last turns would be handed over twice.
    return moved.filter("own OR role <> 'system'").unionByName(system)


def format_conversations(
    df: DataFrame, budget: int = BUDGET, history: int = HISTORY, history_turns: int = HISTORY_TURNS, block: int = BLOCK
) -> DataFrame:
    """Rows conv_id, turn, role, text become rows conv_id, block, stretch, formatted, loss.

    ``formatted`` is a window's text; ``loss`` is array<struct<start, len>> in code points: the (escaped) texts of its
    own assistant turns. A window holds at most ``budget`` tokens (white-space words and marks) unless a single turn
    is longer; no text is cut. Null texts and roles count as empty, a null turn comes first; turns of one number are
    ordered by role and text; a null conv_id is a conversation. Other columns are ignored.
    """
    turns = df.select(
        "conv_id",
        F.coalesce(F.col("turn").cast("long"), F.lit(-1).cast("long")).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        text_or_empty("text").alias("text"),
    ).withColumn("tokens", word_count("text") + TURN_TOKENS)
    rows = _with_handed_over(turns, block, history_turns)
    whole = Window.partitionBy("conv_id", "block")
    order = whole.orderBy("turn", "role", "text", "own")
    rows = rows.withColumn("sys", F.min(F.when(F.col("role") == "system", F.struct("turn", "text", "tokens"))).over(whole))
    rows = rows.withColumn("upto", F.sum(F.when(F.col("own"), F.col("tokens")).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    room = F.greatest(budget - history - F.coalesce("sys.tokens", F.lit(0)), F.lit(1).cast("long"))
    rows = rows.withColumn("room", room)
    rows = rows.withColumn("stretch", F.struct(F.expr("(upto - tokens) div room").alias("from"), F.expr("(upto - 1) div room").alias("to")))
    before = F.collect_list(F.when(F.col("role") != "system", F.struct("turn", "role", "text", "tokens"))).over(order.rowsBetween(-history_turns, -1))
    rows = rows.withColumn("before", before).filter("own")
    turn = F.struct("turn", "role", "text", "before")
    w = rows.groupBy("conv_id", "block", "stretch").agg(F.sort_array(F.collect_list(turn)).alias("turns"), F.first("sys").alias("sys"))
    # History: the nearest turns before the window, as many as fit.
    near = F.aggregate(
        F.reverse(F.get("turns.before", F.lit(0))),
        F.struct(F.lit(0).cast("long").alias("used"), F.lit(True).alias("fits"), F.array().cast("array<struct<role:string,text:string>>").alias("kept")),
        lambda acc, x: F.struct(
            (acc["used"] + x["tokens"]).alias("used"),
            (acc["fits"] & (acc["used"] + x["tokens"] <= history)).alias("fits"),
            F.when(
                acc["fits"] & (acc["used"] + x["tokens"] <= history),
                F.concat(F.array(F.struct(x["role"].alias("role"), x["text"].alias("text"))), acc["kept"]),
            ).otherwise(acc["kept"]).alias("kept"),
        ),
    )["kept"]
    repeated_system = F.when(
        F.col("sys").isNotNull() & (F.col("sys.turn") < F.get("turns.turn", F.lit(0))),
        F.array(F.struct(F.lit("system").alias("role"), F.col("sys.text").alias("text"))),
    ).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
    part = lambda mark, own: lambda x: F.struct(
        F.concat(F.lit(mark), escape_role(x["role"]), F.lit("\n")).alias("head"),
        escape(x["text"]).alias("body"),
        (F.lit(own) & (x["role"] == "assistant")).alias("target"),
    )
    w = w.withColumn("parts", F.concat(F.transform(F.concat(repeated_system, near), part(AGAIN, False)), F.transform("turns", part(START, True))))
    formatted = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    spans = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,len:int>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.char_length(p["head"]) + F.char_length(p["body"]) + len(END)).alias("at"),
            F.when(
                p["target"],
                F.concat(acc["spans"], F.array(F.struct((acc["at"] + F.char_length(p["head"])).alias("start"), F.char_length(p["body"]).alias("len")))),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
    )["spans"]
    return w.select("conv_id", "block", "stretch", formatted.alias("formatted"), spans.alias("loss"))


def read_back(windows: DataFrame) -> DataFrame:
    """Parse formatted windows: ``turns`` (array<struct<role, text>>, repeated turns left out) and ``targets``, the
    unescaped texts under the loss mask. No windows give no rows; a window without turns has empty lists."""
    pieces = F.filter(F.split("formatted", r"<\|end\|>\n", -1), lambda p: p.startswith(START))
    cut_at = lambda p: F.instr(p, F.lit("\n"))
    parsed = F.transform(
        pieces,
        lambda p: F.struct(
            unescape_role(F.substring(p, F.lit(len(START) + 1), cut_at(p) - len(START) - 1)).alias("role"),
            unescape(F.substring(p, cut_at(p) + 1, F.char_length(p))).alias("text"),
        ),
    )
    targets = F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["len"])))
    return windows.withColumns({"turns": parsed, "targets": targets})


def conversation_report(conversations: DataFrame) -> DataFrame:
    """Per conversation what the formatted windows hold, read back from them. The digests need a conversation's text in
    one place; it is assembled per window before that. Null texts and roles are empty, turns of one
    number are ordered by role and text; an empty table leaves the added conversation alone; other columns are ignored."""
    spark: SparkSession = conversations.sparkSession
    extra = spark.sql(
        "SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)"
    )
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
    w = read_back(format_conversations(rows))
    w = w.select(
        "conv_id", "block", "stretch",
        F.size("turns").cast("long").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
        F.array_join("targets", "").alias("loss"),
        F.char_length("formatted").cast("long").alias("chars"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("block", "stretch", "said", "loss")))
    c = w.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), ordered.alias("w"))
    loss = F.array_join("w.loss", "")
    return c.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join("w.said", ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
