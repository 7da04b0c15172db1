"""Packing of sequences into fixed context lengths: best fit over a histogram of lengths, then rows matched to slots.

How sequences share packs depends on their lengths alone, and a context of ``capacity`` tokens has no more lengths than that.
So the plan is made over the histogram, whatever the number of rows; rows get their slot by their rank among those of
their length, and neither texts nor rows are sorted as a whole.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one length that are ranked in one group, and slots that one row of the plan stands for, about.
GROUP_ROWS = 1 << 16


@dataclass
class Shape:
    """``count`` packs alike, each with ``items``: (length, how many of it), longest first."""

    items: tuple[tuple[int, int], ...]
    count: int

    @property
    def tokens(self) -> int:
        return sum(length * n for length, n in self.items)


def plan_packs(histogram: dict[int, int], capacity: int) -> list[Shape]:
    """Best fit, longest first, as if placed one by one: each sequence goes to the pack with the least room that holds it, or
    to a new one. Packs of one history are handled together, so the work grows with the number of lengths."""
    open_: dict[int, list[Shape]] = {}
    rooms: list[int] = []

    def keep(room: int, shape: Shape) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append(shape)

    def fill(room: int, shapes: list[Shape], length: int, left: int) -> int:
        """Put ``left`` sequences into ``shapes``, pack by pack; what is left over."""
        each = room // length
        for s in shapes:
            full = min(s.count, left // each)
            left -= full * each
            part = left if full < s.count else 0
            left -= part
            for n, count in ((each, full), (part, int(part > 0)), (0, s.count - full - int(part > 0))):
                if count:
                    keep(room - n * length, Shape((*s.items, (length, n)) if n else s.items, count))
        return left

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a length of {length} does not fit into {capacity}")
        left = histogram[length]
        while left and (at := bisect_left(rooms, length)) < len(rooms):
            room = rooms.pop(at)
            left = fill(room, open_.pop(room), length, left)
        if left:
            fill(capacity, [Shape((), -(-left // (capacity // length)))], length, left)
    return [s for r in rooms for s in open_[r]]


def _slots(shapes: list[Shape]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, rank of the first, packs, sequences in each, first pack, where the first begins in its pack), of at most
    about GROUP_ROWS sequences each."""
    used: dict[int, int] = defaultdict(int)
    rows, pack = [], 0
    for s in shapes:
        begin = 0
        for length, n in s.items:
            step = max(1, GROUP_ROWS // n)
            for a in range(0, s.count, step):
                m = min(step, s.count - a)
                rows.append((length, used[length], m, n, pack + a, begin))
                used[length] += m * n
            begin += length * n
        pack += s.count
    return rows


def pack(rows: DataFrame, key: str | list[str], length: Column, capacity: int, seed: int = 0) -> DataFrame:
    """``rows`` plus pack (from 0), begin (where the sequence starts in its pack) and tokens (its length). No pack holds more
    than ``capacity``; as many packs come out as from best fit one by one. Which rows of one length go where depends on
    ``seed`` and ``key`` alone; rows of one key and length are interchangeable.

    Sequences of length 0 or null need no place and those above ``capacity`` have none: their pack and begin are null. An
    empty table stays empty. The lengths' counts, ``capacity`` at most, come to the driver, and the plan goes back as rows."""
    spark, key = rows.sparkSession, [key] if isinstance(key, str) else key
    sized = rows.withColumn("tokens", length.cast("long"))
    fits = F.col("tokens").between(1, capacity)
    counts = {r["tokens"]: r["count"] for r in sized.filter(fits).groupBy("tokens").count().collect()}
    shapes = plan_packs(counts, capacity)
    # At most ``capacity`` rows: one per length.
    parts = spark.createDataFrame([(n, -(-c // GROUP_ROWS)) for n, c in counts.items()], "tokens long, _parts long")
    told = sized.withColumn("_order", F.xxhash64(F.lit(seed), *key)).join(F.broadcast(parts), "tokens", "left")
    told = told.withColumn("_group", F.pmod("_order", "_parts"))
    sizes = told.filter(fits).groupBy("tokens", "_group").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.partitionBy("tokens").orderBy("_group")) - F.col("_n")).drop("_n")
    rank = F.row_number().over(Window.partitionBy("tokens", "_group").orderBy("_order", *key)) - 1
    # Rows without a place take no part in the ranks: alone in a group each would be one large group.
    ranked = told.filter(fits).withColumn("_rank", rank).join(before, ["tokens", "_group"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    plan = spark.createDataFrame(_slots(shapes), "tokens long, first long, packs long, each long, pack long, begin long")
    slot = F.explode(F.sequence(F.lit(0).cast("long"), F.col("packs") * F.col("each") - 1))
    slots = plan.withColumn("_at", slot).select(
        "tokens",
        (F.col("first") + F.col("_at")).alias("_rank"),
        (F.col("pack") + F.expr("_at div each")).alias("pack"),
        (F.col("begin") + F.expr("_at % each") * F.col("tokens")).alias("begin"),
    )
    placed = ranked.join(slots, ["tokens", "_rank"], "left").select(*rows.columns, "pack", "begin", "tokens")
    rest = told.filter(~F.coalesce(fits, F.lit(False))).select(*rows.columns, F.lit(None).cast("long").alias("pack"), F.lit(None).cast("long").alias("begin"), "tokens")
    return placed.unionAll(rest)


def packed_rows(packed: DataFrame, items: Column) -> DataFrame:
    """One row per pack: pack, n, tokens, and ``items`` as a list in the pack's order. A pack has ``capacity`` tokens at most."""
    listed = F.sort_array(F.collect_list(F.struct("begin", items.alias("item"))))
    return packed.filter("pack IS NOT NULL").groupBy("pack").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"), listed.alias("_items")).select("pack", "n", "tokens", F.col("_items.item").alias("items"))
