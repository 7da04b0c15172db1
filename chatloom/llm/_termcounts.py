"""Occurrences of terms by group, summed inside Arrow tasks before anything is shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import text_or_empty
from ._wordhash import Words, mix, pieces

#: Rows and bytes of terms that a task sums up before it passes them on; a row takes about 40 bytes besides.
HELD, HELD_BYTES = 1 << 20, 64 << 20
#: Terms whose bytes are picked at once.
STEP = 1 << 14
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def group_salt(numbers: np.ndarray) -> np.ndarray:
    """A value per group number that keeps the hashes of equal words in different groups apart."""
    return mix(numbers.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))


class _Terms:
    """Rows of (key, group, count, texts that hold it) with the term's bytes, one row per key."""

    def __init__(self, key: np.ndarray, group: np.ndarray, count: np.ndarray, texts: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.key, self.group, self.count, self.texts = key, group, count, texts
        self.data, self.start, self.size = data, start, size

    def bytes_of(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.concatenate([[0], np.cumsum(self.size)])
        out = np.empty(int(at[-1]), np.uint8)
        for a in range(0, len(self.size), STEP):  # 24 bytes of numbers for each byte that is picked at once
            size, begin, end = self.size[a : a + STEP], int(at[a]), int(at[min(a + STEP, len(self.size))])
            out[begin:end] = self.data[np.repeat(self.start[a : a + STEP] - at[a : a + len(size)], size) + np.arange(begin, end)]
        return out, at

    @classmethod
    def of_words(cls, w: Words, group: np.ndarray) -> _Terms:
        """``group``: a number per text."""
        text = np.repeat(np.arange(len(group)), np.diff(w.first))
        key = w.hash ^ group_salt(group)[text]
        order = np.argsort(key, kind="stable")
        sorted_key, text = key[order], text[order]
        new = np.ones(len(order), bool)
        np.not_equal(sorted_key[1:], sorted_key[:-1], out=new[1:])
        new_text = new.copy()
        new_text[1:] |= text[1:] != text[:-1]
        at = np.flatnonzero(new)
        first = order[at]
        texts = np.add.reduceat(new_text, at, dtype=np.int64) if len(at) else np.empty(0, np.int64)
        return cls(sorted_key[at], group[text[at]], np.diff(np.append(at, len(order))), texts, w.data, w.start[first], w.end[first] - w.start[first])

    @classmethod
    def merged(cls, parts: list[_Terms]) -> _Terms:
        key = np.concatenate([p.key for p in parts])
        order = np.argsort(key, kind="stable")
        new = np.ones(len(order), bool)
        np.not_equal(key[order][1:], key[order][:-1], out=new[1:])
        at = np.flatnonzero(new)
        raw = [p.bytes_of() for p in parts]
        begin = np.cumsum([0, *[len(d) for d, _ in raw]])
        start = np.concatenate([r[1][:-1] + b for r, b in zip(raw, begin, strict=False)])
        size = np.concatenate([p.size for p in parts])
        add = lambda name: np.add.reduceat(np.concatenate([getattr(p, name) for p in parts])[order], at) if len(at) else np.empty(0, np.int64)
        first = order[at]
        group = np.concatenate([p.group for p in parts])[first]
        kept = cls(key[first], group, add("count"), add("texts"), np.concatenate([d for d, _ in raw]), start[first], size[first])
        kept.data, at = kept.bytes_of()
        kept.start = at[:-1]
        return kept


def _string_array(t: _Terms) -> pa.Array:
    data, at = t.bytes_of()
    return pa.StringArray.from_buffers(len(t.key), pa.py_buffer(at.astype(np.int32)), pa.py_buffer(_LOWER[data]))


def term_counts(docs: DataFrame, groups: dict[str, Column], separators: np.ndarray, text: str = "text", held_rows: int = HELD) -> DataFrame:
    """(group columns, term, n, texts): how often each term stands in a group's texts and in how many of them. Terms are
    what ``separators`` (by byte) part, A-Z lower-cased. Every group that occurs also has a row with a null term.

    Tasks sum what they read, ``held_rows`` rows and HELD_BYTES at most, so that a frequent term of a large group is a few rows of each
    task; the rest is Spark's aggregate. Within a task words are told apart by 64-bit hashes, afterwards by themselves."""
    names = list(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[tuple, int] = {}
        held: list[_Terms] = []

        def out(t: _Terms) -> Iterator[pa.RecordBatch]:
            known = list(numbers)
            columns = [pa.array([k[i] for k in known], pa.string()) for i in range(len(names))]
            for a in range(0, len(t.key), 1 << 16):
                part = _Terms(*(x[a : a + (1 << 16)] for x in (t.key, t.group, t.count, t.texts)), t.data, *(x[a : a + (1 << 16)] for x in (t.start, t.size)))
                which = pa.array(part.group, pa.int64())
                cols = [c.take(which) for c in columns]
                yield pa.record_batch([*cols, _string_array(part), pa.array(part.count, pa.int64()), pa.array(part.texts, pa.int64())], [*names, "term", "n", "texts"])

        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(len(names))), strict=True))
            number = np.array([numbers.setdefault(k, len(numbers)) for k in keys], np.int64)
            for begin, data, at in pieces(batch.column(len(names))):
                # The words' bytes are copied: what is held must not keep the whole batch.
                held.append(_Terms.merged([_Terms.of_words(Words(data, at, separators), number[begin : begin + len(at) - 1])]))
                if sum(len(t.key) for t in held) > held_rows or sum(len(t.data) for t in held) > HELD_BYTES:
                    held = [_Terms.merged(held)]
                    if len(held[0].key) > held_rows // 2 or len(held[0].data) > HELD_BYTES // 2:
                        yield from out(held.pop())
        if held:
            yield from out(_Terms.merged(held))
        empty = pa.array([0] * len(numbers), pa.int64())
        known = list(numbers)
        yield pa.record_batch([*(pa.array([k[i] for k in known], pa.string()) for i in range(len(names))), pa.nulls(len(known), pa.string()), empty, empty], [*names, "term", "n", "texts"])

    rows = docs.select(*[c.alias(n) for n, c in groups.items()], text_or_empty(text).alias("text_"))
    schema = ", ".join(f"`{n}` string" for n in names)
    counted = rows.mapInArrow(run, f"{schema}, term string, n long, texts long")
    return counted.groupBy(*names, "term").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
