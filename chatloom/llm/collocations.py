"""Phrase collocation mining: phrases whose words stand together more often than their parts would by chance.

Phrases grow word by word. Only a phrase whose first and last words but one are frequent phrases themselves can be frequent,
so each length counts what the length before left. A phrase is the packed pair (number of its first words' phrase, number
of its last word), counted in counting quotient filters inside the tasks, which are merged shard by shard; counts are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import cut, small_batches, text_or_empty
from ._quotient import ShardedCounter, merged, unmix, unpack
from ._termcounts import term_counts
from ._wordhash import Words, mix, pieces

LEAST_COUNT = 100
MOST_WORDS = 5
TOP_PHRASES = 2000
NO_LANG = "und"
#: Entries of the dictionary that a worker holds at once, 12 bytes each; more are taken in blocks, one pass each.
MOST_IDS = 1 << 22
#: Distinct words that a task sums up before it passes them on: about 300 bytes each at the peak, two tasks beside a JVM.
HELD_WORDS = 1 << 19
#: Phrase occurrences to a shard of the filters, about.
SHARD_KEYS = 1 << 21
#: Bytes that end a piece of a text; with blank and tab, those between words.
BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BETWEEN = BREAKS.copy()
BETWEEN[[0x20, 0x09]] = True


def numbered(rows: DataFrame, key: list[str], part_rows: int = 1 << 15) -> tuple[DataFrame, int]:
    """(``rows`` with a dense ``id`` from 1, their number), numbered inside parts of about ``part_rows`` rows by the key's
    hash. The driver holds one count per part."""
    n = rows.count()
    parts = max(1, -(-n // part_rows))
    if n >= 1 << 32:
        raise ValueError(f"{n} frequent phrases of one length: their numbers have 32 bits")
    rows = rows.withColumn("part", F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int"))
    counts = {r["part"]: r["count"] for r in rows.groupBy("part").count().collect()}
    before = np.cumsum([0, *(counts.get(p, 0) for p in range(parts))])
    offsets = rows.sparkSession.createDataFrame([(p, int(before[p])) for p in range(parts)], "part int, before long")
    at = F.row_number().over(Window.partitionBy("part").orderBy(*key))
    # One row for each part_rows rows, and at most 2 MB for the most ids there can be.
    return rows.withColumn("at", at).join(F.broadcast(offsets), "part").withColumn("id", F.col("before") + F.col("at")).drop("part", "at", "before"), n


def lang_salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "big")


def _word_keys(part: pa.Table) -> np.ndarray:
    """Keys of (lang, term) rows."""
    salt = {x: lang_salt(x) for x in part.column("lang").unique().to_pylist()}
    w = Words.of([t.encode() for t in part.column("term").to_pylist()], BETWEEN)
    return w.hash ^ mix(np.array([salt[x] for x in part.column("lang").to_pylist()], np.uint64))


def _phrase_keys(part: pa.Table) -> np.ndarray:
    return part.column("left").to_numpy().astype(np.uint64) << np.uint64(32) | part.column("last").to_numpy().astype(np.uint64)


def _blocks(table: DataFrame, n: int, keys_of: Callable[[pa.Table], np.ndarray], columns: list[str], most_ids: int) -> Iterator:
    """The dictionary's blocks, broadcast one after the other as (sorted keys, their ids): ``most_ids`` entries at most on
    average, by hash, so that none is much larger."""
    spark, blocks = table.sparkSession, max(1, -(-n // most_ids))
    for b in range(blocks):
        mine = table.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).select("id", *columns).toArrow()
        keys = np.concatenate([np.empty(0, np.uint64), *[keys_of(mine.slice(a, 1 << 16)) for a in range(0, mine.num_rows, 1 << 16)]])
        order = np.argsort(keys)
        shared = spark.sparkContext.broadcast((keys[order], mine.column("id").to_numpy()[order].astype(np.uint32)))
        yield b == blocks - 1, shared


def _look_up(keys: np.ndarray, wanted: np.ndarray, block: tuple[np.ndarray, np.ndarray], into: np.ndarray) -> None:
    known, ids = block
    if len(known):
        where = np.flatnonzero(wanted)
        at = np.minimum(np.searchsorted(known, keys[where]), len(known) - 1)
        hit = known[at] == keys[where]
        into[where[hit]] = ids[at[hit]]


def _numbers(col: pa.Array) -> np.ndarray:
    """The numbers of all rows of a column, as they lie in memory."""
    at = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2] or b"", np.uint8)[at[0] : at[-1]].view(np.uint32)


def _runs(keep: np.ndarray, *arrays: np.ndarray) -> list[bytes]:
    """What is kept of each array, runs apart by one zero and with one behind the last."""
    keep = np.append(keep, False)
    ends = np.append(False, keep[:-1]) & ~keep
    pick = np.flatnonzero(keep | ends)
    return [np.where(keep[pick], np.append(a, 0)[pick], 0).astype(np.uint32).tobytes() for a in arrays]


def _stream(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of each word in a stream where a zero ends each piece, length of the stream, where each text begins in it)."""
    breaks = np.concatenate([[0], np.cumsum(BREAKS[w.data])])
    new = np.zeros(len(w.start), np.int64)
    new[1:] = breaks[w.start[1:]] > breaks[w.end[:-1]]
    firsts = w.first[:-1][(w.first[:-1] > 0) & (w.first[:-1] < len(new))]
    new[firsts] = 1
    place = np.arange(len(new)) + np.cumsum(new)
    size = int(place[-1]) + 2 if len(place) else 0
    return place, size, np.append(place, size)[w.first]


def _encode(rows: DataFrame, shared, last: bool) -> DataFrame:
    """(lang, text, w) to the same with the ids of one more block in ``w``; after the last block only ``w``, without the
    words that stand alone between words that are not frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, salts = shared.value, {}
        for batch in batches:
            langs, so_far = batch.column(0).to_pylist(), batch.column(2)
            for begin, data, at in pieces(batch.column(1)):
                w = Words(data, at, BETWEEN)
                n = len(at) - 1
                salt = np.array([salts.setdefault(x, lang_salt(x)) for x in langs[begin : begin + n]], np.uint64)
                place, size, texts = _stream(w)
                ids = _numbers(so_far.slice(begin, n)).copy()
                if len(ids) != size:
                    ids = np.zeros(size, np.uint32)
                found = ids[place]
                _look_up(w.hash ^ np.repeat(mix(salt), np.diff(w.first)), found == 0, block, found)
                ids[place] = found
                if last:
                    some = ids != 0
                    near = np.append(some[1:], False)[: len(some)] | np.append(False, some[:-1])[: len(some)]
                    yield pa.record_batch([pa.array(_runs(some & near, ids), pa.binary())], ["w"])
                else:
                    told = pa.array([ids[a:b].tobytes() for a, b in zip(texts[:-1], texts[1:], strict=True)], pa.binary())
                    yield pa.record_batch([batch.column(0).slice(begin, n), batch.column(1).slice(begin, n), told], ["lang", "text", "w"])

    return rows.mapInArrow(run, "w binary" if last else "lang string, text string, w binary")


def _keys(w: np.ndarray, g: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(packed phrase of so many words from each place on, whether there is one): ``g`` has the phrases of one word less."""
    n = max(0, len(w) - words + 1)
    there = (g[:n] != 0) & (np.append(g[1:], 0)[:n] != 0)
    return g[:n].astype(np.uint64) << np.uint64(32) | w[words - 1 :][:n].astype(np.uint64), there


def _counts(rows: DataFrame, words: int, shard_bits: int, least: int) -> DataFrame:
    """(left, last, n) of phrases that stand ``least`` times or more: filters of each task, merged by shard."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = ShardedCounter(shard_bits)

        def out(filters) -> Iterator[pa.RecordBatch]:
            for shard, raw in filters:
                yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([raw], pa.binary())], ["shard", "filter"])

        for batch in batches:
            for i in range(batch.num_rows):
                keys, there = _keys(*(_numbers(batch.column(c).slice(i, 1)) for c in (0, 1)), words)
                yield from out(counter.add(keys[there]))
        yield from out(counter.rest())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(shard: int, parts) -> Iterator[pa.RecordBatch]:
            keys, n = merged(unpack(raw, shard, shard_bits) for raw in parts)
            keys, n = unmix(keys[n >= least]), n[n >= least]
            for a in range(0, len(keys), 1 << 16):
                k = keys[a : a + (1 << 16)]
                cols = [(k >> np.uint64(32)).astype(np.int64), (k & np.uint64(0xFFFFFFFF)).astype(np.int64), n[a : a + (1 << 16)]]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in cols], ["left", "last", "n"])

        now, parts = None, []
        for batch in batches:
            for shard, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if shard != now:
                    yield from out(now, parts) if parts else ()
                    now, parts = shard, []
                parts.append(raw.as_py())
        yield from out(now, parts) if parts else ()

    filters = rows.mapInArrow(count, "shard int, filter binary").repartition("shard").sortWithinPartitions("shard")
    return filters.mapInArrow(merge, "left long, last long, n long")


def _narrow(rows: DataFrame, words: int, shared, last: bool) -> DataFrame:
    """(w, g, h) to the same with the ids of one more block in ``h``; after the last block (w, g) where ``g`` are phrases of
    ``words`` words and only places stay that a longer phrase can hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                w, g, h = (_numbers(batch.column(c).slice(i, 1)) for c in range(3))
                h = h.copy() if len(h) else np.zeros(len(w), np.uint32)
                keys, there = _keys(w, g, words)
                _look_up(keys, there, block, h)
                if not last:
                    yield pa.record_batch([*(batch.column(c).slice(i, 1) for c in (0, 1)), pa.array([h.tobytes()], pa.binary())], ["w", "g", "h"])
                    continue
                both = np.flatnonzero((h[:-1] != 0) & (h[1:] != 0))
                if len(both):
                    change = np.bincount(both, minlength=len(w) + 1) - np.bincount(both + words + 1, minlength=len(w) + 1)
                    yield pa.record_batch([pa.array([x], pa.binary()) for x in _runs(np.cumsum(change[:-1]) > 0, w, h)], ["w", "g"])

    return rows.mapInArrow(run, "w binary, g binary" if last else "w binary, g binary, h binary")


def frequent_phrases(docs: DataFrame, lang: Column, least: int = LEAST_COUNT, most_words: int = MOST_WORDS, most_ids: int = MOST_IDS) -> tuple[DataFrame, list[DataFrame]]:
    """((lang, n) with all word occurrences, tables of the frequent words and phrases by length). Words: (id, lang, term, n);
    phrases: (id, left, last, n) with the ids of the phrase without its last word and of that word."""
    words = cut(term_counts(docs, {"lang": lang}, BETWEEN, held_rows=HELD_WORDS).filter("term IS NOT NULL").drop("texts"))
    langs = words.groupBy("lang").agg(F.sum("n").alias("n"))
    found, size = numbered(words.filter(F.col("n") >= least), ["lang", "term"])
    levels = [cut(found)]
    total = langs.agg(F.sum("n")).first()[0] or 0
    shard_bits = max(8, int(total // SHARD_KEYS).bit_length())
    rows = docs.select(lang.alias("lang"), text_or_empty().alias("text"), F.lit(b"").alias("w"))
    if size == 0 or most_words < 2:
        return langs, levels
    for last, shared in _blocks(levels[0], size, _word_keys, ["lang", "term"], most_ids):
        rows = cut(_encode(rows, shared, last))
        shared.destroy()
    rows = rows.select("w", F.col("w").alias("g"))
    for words_now in range(2, most_words + 1):
        found, size = numbered(cut(_counts(rows, words_now, shard_bits, least)), ["left", "last"])
        levels.append(cut(found))
        if size == 0 or words_now == most_words:
            break
        rows = rows.withColumn("h", F.lit(b""))
        for last, shared in _blocks(levels[-1], size, _phrase_keys, ["left", "last"], most_ids):
            rows = cut(_narrow(rows, words_now, shared, last))
            shared.destroy()
    return langs, levels


def _named(levels: list[DataFrame]) -> list[DataFrame]:
    """The phrases by length as (id, lang, phrase, n, heads, tails): the counts of their first 1, 2, ... words and of their last
    1, 2, ... words, themselves included."""
    counts = F.array("n")
    words = levels[0].select("id", "lang", F.col("term").alias("phrase"), "n", counts.alias("heads"), counts.alias("tails"))
    named = [words]
    for level in levels[1:]:
        before = named[-1]
        left = before.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("first"), "heads")
        last = words.select(F.col("id").alias("last"), F.col("phrase").alias("word"))
        whole = level.join(left, "left").join(last, "last").withColumn("phrase", F.concat_ws(" ", "first", "word"))
        suffix = before.select("lang", F.col("phrase").alias("rest"), "tails", F.col("id").alias("right"))
        whole = whole.withColumn("rest", F.expr("substring(phrase, instr(phrase, ' ') + 1)")).join(suffix, ["lang", "rest"])
        own = F.array("n")
        named.append(cut(whole.select("id", "lang", "phrase", "n", F.concat("heads", own).alias("heads"), F.concat("tails", own).alias("tails"), "left", "right")))
    return named


def collocations(docs: DataFrame, least: int = LEAST_COUNT, most_words: int = MOST_WORDS, top: int = TOP_PHRASES, most_ids: int = MOST_IDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to ``most_words`` words that stand
    ``least`` times or more, by score, then count, then phrase. The score is floor(1000 * a * n / (l * r)) for the cut of
    the phrase where that is lowest, at the smallest place of these. A phrase that stands only inside longer ones that are
    as frequent is left to them.

    Null text is empty, null lang is ``und``; repeated rows count as often as they stand; other columns are ignored; an
    empty table and texts without frequent phrases give no rows."""
    lang = F.coalesce(F.col("lang"), F.lit(NO_LANG))
    with small_batches(docs.sparkSession):
        langs, levels = frequent_phrases(docs, lang, least, most_words, most_ids)
    named = _named(levels)
    of_cut = """array_min(transform(sequence(1, size(heads) - 1), k -> named_struct(
        'score', (CAST(a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(19, 0)) * 1000BD) div (CAST(heads[k - 1] AS DECIMAL(19, 0)) * CAST(tails[size(heads) - k - 1] AS DECIMAL(19, 0))),
        'k', k, 'l', heads[k - 1], 'r', tails[size(heads) - k - 1])))"""
    out = []
    for i, level in enumerate(named[1:], 1):
        if i + 1 < len(named):
            longer = named[i + 1]
            # The count of the phrase inside is the one before last of the longer one's heads or tails.
            inside = longer.select(F.explode(F.expr("filter(array(IF(heads[size(heads) - 2] = n, left, NULL), IF(tails[size(tails) - 2] = n, right, NULL)), x -> x IS NOT NULL)")).alias("id"))
            level = level.join(inside.distinct(), "id", "left_anti")
        out.append(level.select("lang", "phrase", F.col("n").alias("a"), "heads", "tails"))
    if not out:
        return docs.sparkSession.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    rows = out[0]
    for more in out[1:]:
        rows = rows.unionAll(more)
    rows = rows.join(langs, "lang").withColumn("cut", F.expr(of_cut)).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")
    return rows.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
