"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows, scanned over every document.

The set is broadcast only up to a checked number of windows; a larger benchmark is taken in blocks, one scan of the texts
each, whose hits are brought together by row. Hash hits are verified on the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import cut, free_names, text_or_empty
from ._wordhash import NOT_WORD, Words, pieces

WINDOW = 10
#: The words that NOT_WORD parts, as a Java pattern; A-Z belong to them in either case.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ADDED = ("mask", "items", "n_words", "n_hit")
#: Windows in one broadcast set: at about 250 bytes a window, 125 MB in a worker.
MOST_WINDOWS = 500_000


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Distinct (n, words, items): windows of ``window`` words, the whole item if it has fewer, nothing if it has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, data, at in pieces(batch.column(1)):
                w, ids = Words(data, at, NOT_WORD), batch.column(0).slice(begin).to_pylist()
                rows = []
                for i in range(len(at) - 1):
                    a, b = int(w.first[i]), int(w.first[i + 1])
                    n = min(window, b - a)
                    if n:
                        rows += [(n, w.gram_text(j, n), ids[i]) for j in range(a, b - n + 1)]
                cols = list(zip(*rows, strict=True)) or [(), (), ()]
                yield pa.record_batch([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.string())], ["n", "words", "item"])

    raw = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).filter("item IS NOT NULL")
    rows = raw.mapInArrow(run, "n int, words binary, item string")
    return rows.groupBy("n", "words").agg(F.collect_set("item").alias("items"))


class WindowSet:
    """Windows of one block, for lookup by hash and check by words. ``lengths`` has for each number of words a filter of
    the hashes' first bits and the windows by hash."""

    def __init__(self, rows: list[tuple[int, bytes, list[str]]]):
        self.lengths: dict[int, tuple[np.ndarray, dict[int, dict[bytes, list[str]]]]] = {}
        for n in sorted({r[0] for r in rows}):
            by_hash: dict[int, dict[bytes, list[str]]] = {}
            mine = [(bytes(r[1]), list(r[2])) for r in rows if r[0] == n]
            for k in range(0, len(mine), 10_000):
                part = mine[k : k + 10_000]
                w = Words.of([x[0] for x in part], NOT_WORD)
                for (words, items), h in zip(part, w.grams(n)[w.first[:-1]], strict=True):
                    by_hash.setdefault(int(h), {})[words] = items
            seen = np.zeros(1 << min(22, max(10, len(by_hash).bit_length() + 4)), bool)
            seen[np.array(list(by_hash), np.uint64) >> _beyond(seen)] = True
            self.lengths[n] = (seen, by_hash)


def _beyond(seen: np.ndarray) -> np.uint64:
    return np.uint64(65 - len(seen).bit_length())


def _scan(batches: Iterator[pa.RecordBatch], windows: WindowSet, added: tuple) -> Iterator[pa.RecordBatch]:
    """Append mask (a bit per word, empty if no hit), items, n_words and n_hit under the names ``added``."""
    for batch in batches:
        names = batch.schema.names
        masks, items, counts = [], [], []
        for _, data, place in pieces(batch.column("text")):
            w = Words(data, place, NOT_WORD)
            hit = np.zeros(len(w.hash) + 1, np.int32)
            found: list[set[str]] = [set() for _ in place[1:]]
            for n, (seen, by_hash) in windows.lengths.items():
                g = w.grams(n)
                at = np.flatnonzero(seen[g >> _beyond(seen)])
                if not len(at):
                    continue
                doc = np.searchsorted(w.first, at, "right") - 1
                whole = at + n <= w.first[doc + 1]
                for i, d in zip(at[whole], doc[whole], strict=True):
                    same = by_hash.get(int(g[i]))
                    if same and (ids := same.get(w.gram_text(i, n))):
                        hit[i] += 1
                        hit[i + n] -= 1
                        found[d].update(ids)
            is_hit = np.cumsum(hit[:-1]) > 0
            for i in range(len(found)):
                bits = is_hit[w.first[i] : w.first[i + 1]]
                masks.append(np.packbits(bits).tobytes() if bits.any() else b"")
                items.append(sorted(found[i]))
                counts.append((len(bits), int(bits.sum())))
        new = [
            pa.array(masks, pa.binary()),
            pa.array(items, pa.list_(pa.string())),
            pa.array([c[0] for c in counts], pa.int64()),
            pa.array([c[1] for c in counts], pa.int64()),
        ]
        yield pa.record_batch([*batch.columns, *new], [*names, *added])


def _any_bit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, masks of one document from several blocks, items to id, mask, items, n_hit."""
    for batch in batches:
        masks = [np.bitwise_or.reduce([np.frombuffer(m, np.uint8) for m in x]) for x in batch.column(1).to_pylist()]
        hits = pa.array([int(np.unpackbits(m).sum()) for m in masks], pa.int64())
        yield pa.record_batch([batch.column(0), pa.array([m.tobytes() for m in masks], pa.binary()), batch.column(2), hits], ["id", "mask", "items", "n_hit"])


def mark_contamination(docs: DataFrame, benchmark: DataFrame, most_windows: int = MOST_WINDOWS) -> DataFrame:
    """``docs`` (with ``text``) plus mask, items, n_words, n_hit; where ``docs`` has columns of these names, the new ones get
    underscores behind theirs. Null texts have no words; an empty benchmark hits nothing; a null item_id is ignored;
    repeated rows are told alike."""
    return _marked(docs, benchmark, free_names(docs, *ADDED), most_windows)


def _marked(docs: DataFrame, benchmark: DataFrame, added: tuple, most_windows: int = MOST_WINDOWS) -> DataFrame:
    spark = docs.sparkSession
    windows = cut(benchmark_windows(benchmark))
    blocks = max(1, -(-windows.count() // most_windows))
    told = "{} binary, {} array<string>, {} bigint, {} bigint"

    def scan(rows: DataFrame, block: int, names: tuple):
        mine = windows.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block)
        # Built once here and once more in each worker, not in each task.
        shared = spark.sparkContext.broadcast(WindowSet([tuple(r) for r in mine.toLocalIterator()]))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        return rows.mapInArrow(_scanner(shared, names), f"{schema}, {told.format(*names)}"), shared

    if blocks == 1:
        return scan(docs, 0, added)[0]
    # The documents are written once; each block reads their texts and leaves only what it hits.
    rows = cut(docs.select(F.monotonically_increasing_id().alias("id"), F.struct("*").alias("row")))
    hits = []
    for b in range(blocks):
        found, shared = scan(rows.select("id", F.col("row.text").alias("text")), b, ADDED)
        hits.append(cut(found.filter("n_hit > 0").select("id", "mask", "items")))
        shared.destroy()
    of_row = reduce(DataFrame.unionAll, hits).groupBy("id")
    # One mask and one list of items from each block at most.
    of_row = of_row.agg(F.collect_list("mask").alias("masks"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    merged = cut(of_row.mapInArrow(_any_bit, "id long, mask binary, items array<string>, n_hit long"))
    values = (
        F.coalesce("mask", F.lit(b"")),
        F.coalesce("items", F.array().cast("array<string>")),
        F.regexp_count(text_or_empty("row.text"), F.lit(WORD_PATTERN)).cast("long"),
        F.coalesce("n_hit", F.lit(0).cast("long")),
    )
    return rows.join(merged, "id", "left").select("row.*", *[v.alias(n) for v, n in zip(values, added, strict=True)])


def _scanner(shared, added: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _scan(batches, shared.value, added)

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents") -> DataFrame:
    """``docs`` without what the benchmark holds: hit documents go, or (remove="spans") only the hit words with
    what stands between them. All columns, whatever their names, and all other rows stay as they were; null texts and
    an empty benchmark have no hits."""
    added = free_names(docs, *ADDED)
    marked, names = _marked(docs, benchmark, added), docs.columns
    if remove == "documents":
        return marked.filter(F.col(added[3]) == 0).drop(*added)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, masks = batch.column("text").to_pylist(), batch.column(added[0]).to_pylist()
            for i, m in enumerate(masks):
                if m:
                    texts[i] = _without(texts[i].encode(), m)
            cols = [batch.column(n) if n != "text" else pa.array(texts, pa.string()) for n in batch.schema.names]
            yield pa.record_batch(cols, batch.schema.names).select(names)

    return marked.mapInArrow(clean, docs.schema)


def _without(raw: bytes, mask: bytes) -> str:
    w = Words.of([raw], NOT_WORD)
    bits = np.concatenate([[0], np.unpackbits(np.frombuffer(mask, np.uint8), count=len(w.start)), [0]]).astype(np.int8)
    turn = np.flatnonzero(np.diff(bits))
    out, at = [], 0
    for a, b in zip(turn[0::2], turn[1::2], strict=True):
        out.append(raw[at : w.start[a]])
        at = w.end[b - 1]
    return b"".join([*out, raw[at:]]).decode()


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document; null texts have no words. Columns besides doc_id and text are ignored."""
    marked = mark_contamination(docs.select("doc_id", "text"), benchmark)
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
