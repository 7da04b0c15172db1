"""Byte-pair tokens of texts and loss masks over them. The vocabulary is a public rank file whose path is a parameter.

Workers look words up in a memo, which they keep from task to task, and merge only the new ones; long words with a heap of
pairs, so that time grows with the text also where a word is very long.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterable, Iterator
from itertools import batched, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how byte-level vocabularies of this kind part a text into words.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries that a vocabulary may have, as every task holds it; words that a memo holds, and the longest of them in bytes.
MOST_RANKS, MEMO_WORDS, MEMO_BYTES = 1 << 20, 1 << 19, 64
#: Characters from which on a text's words are taken some at a time, and rows that are masked together.
LONG_TEXT, MASKED_ROWS = 1 << 20, 256
#: Above every rank.
NO_RANK = 1 << 40


def read_ranks(spark: SparkSession, path: str = RANKS) -> dict[bytes, int]:
    """Bytes of a token to its rank, which is its id, from lines of base64 and number."""
    rows = spark.read.text(path).filter("value <> ''").selectExpr("unbase64(split_part(value, ' ', 1)) AS token", "CAST(split_part(value, ' ', 2) AS INT) AS rank")
    found = rows.limit(MOST_RANKS + 1).collect()
    if len(found) > MOST_RANKS:
        raise ValueError(f"{path} has more than {MOST_RANKS} entries")
    return {bytes(r.token): r.rank for r in found}


class BytePairs:
    def __init__(self, ranks: dict[bytes, int], memo: dict[str, bytes] | None = None):
        self.ranks, self.memo = ranks, {} if memo is None else memo
        self.words = regex.compile(WORDS)

    def merge(self, raw: bytes) -> list[tuple[int, int]]:
        """(id, bytes) of a word's tokens: the neighbours of the lowest rank merge first, the left ones of equals."""
        return self._merge_short(raw) if len(raw) <= MEMO_BYTES else self._merge_long(raw)

    def _merge_short(self, raw: bytes) -> list[tuple[int, int]]:
        ranks, edges = self.ranks, list(range(len(raw) + 1))
        get = ranks.get
        pairs = [get(raw[i : i + 2], NO_RANK) for i in range(len(raw) - 1)]
        while pairs and (low := min(pairs)) < NO_RANK:
            i = pairs.index(low)
            del pairs[i], edges[i + 1]
            if i < len(pairs):
                pairs[i] = get(raw[edges[i] : edges[i + 2]], NO_RANK)
            if i:
                pairs[i - 1] = get(raw[edges[i - 1] : edges[i + 1]], NO_RANK)
        return [(ranks[raw[a:b]], b - a) for a, b in zip(edges, edges[1:], strict=False)]

    def _merge_long(self, raw: bytes) -> list[tuple[int, int]]:
        n, ranks = len(raw), self.ranks
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        end = list(range(1, n + 1))  # 0 where a part was merged away
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := ranks.get(raw[i : end[j]])) is not None:
                heap.append((rank, i, end[j])) if not ready else heapq.heappush(heap, (rank, i, end[j]))

        ready = False
        for i in range(n):
            offer(i)
        heapq.heapify(heap)
        ready = True
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i] if end[i] else n
            if j >= n or end[j] != stop or end[i] == stop:
                continue
            end[i], end[j] = stop, 0
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append((ranks[raw[i : end[i]]], end[i] - i))
            i = after[i]
        return out

    def _learn(self, word: str) -> bytes:
        raw, memo = word.encode("utf-8", "surrogatepass"), self.memo
        found = packed(self.merge(raw))
        if len(raw) <= MEMO_BYTES:
            if len(memo) >= MEMO_WORDS:
                memo.clear()
            memo[word] = found
        return found

    def encode_packed(self, text: str) -> bytes:
        """The tokens of a text as ``packed`` has them; together they are the text's bytes."""
        get, out = self.memo.get, []
        for words in [self.words.findall(text)] if len(text) < LONG_TEXT else batched((m[0] for m in self.words.finditer(text)), 1 << 16):
            known = list(map(get, words))
            if None in known:
                known = [k or get(w) or self._learn(w) for w, k in zip(words, known, strict=True)]
            out.append(b"".join(known))
        return b"".join(out)

    def encode(self, text: str) -> list[tuple[int, int]]:
        """(id, bytes) of all tokens; together they are the text's bytes."""
        return list(map(tuple, unpacked([self.encode_packed(text)]).tolist()))


def packed(tokens: Iterable[tuple[int, int]]) -> bytes:
    """(id, bytes) of tokens as 32-bit numbers in turn: what memos hold, as it takes little room and is quickly joined."""
    flat = list(chain.from_iterable(tokens))
    return struct.pack(f"={len(flat)}i", *flat)


def unpacked(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(parts), np.int32).reshape(-1, 2)


def _lists(parts: list[bytes], values: np.ndarray) -> pa.ListArray:
    """One list for each part, with as many values as the part has tokens."""
    ends = np.cumsum([0, *(len(p) // 8 for p in parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def _added(df: DataFrame, *fields: StructField) -> StructType:
    return StructType([*df.schema.fields, *fields])


def with_token_ids(df: DataFrame, text: str = "text", ranks: str = RANKS, out: str = "token_ids") -> DataFrame:
    """``df`` plus an array with the ids of the column's tokens; null counts as empty."""
    shared = df.sparkSession.sparkContext.broadcast((read_ranks(df.sparkSession, ranks), {}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = BytePairs(*shared.value)
        for b in batches:
            parts = [pairs.encode_packed(x or "") for x in b.column(b.schema.names.index(text)).to_pylist()]
            yield pa.record_batch([*b.columns, _lists(parts, np.ascontiguousarray(unpacked(parts)[:, 0]))], [*b.schema.names, out])

    return df.mapInArrow(run, _added(df, StructField(out, ArrayType(IntegerType()))))


def with_token_counts(df: DataFrame, most: int, text: str = "text", ranks: str = RANKS) -> DataFrame:
    """``df`` plus tokens (how many the text has) and long (more than three quarters of ``most``); null counts as empty and
    no row is dropped. Only the texts go to Python, and only numbers come back beside the row."""
    shared = df.sparkSession.sparkContext.broadcast((read_ranks(df.sparkSession, ranks), {}))

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pairs = BytePairs(*shared.value)
        for texts in batches:
            yield pa.array([len(pairs.encode_packed(t or "")) // 8 for t in texts.to_pylist()], pa.int64())

    return df.withColumn("tokens", count(F.col(text))).withColumn("long", F.col("tokens") * 4 > 3 * most)


def masked(sizes: np.ndarray, spans: np.ndarray, loss: np.ndarray) -> np.ndarray:
    """Whether each token has loss: all of its bytes lie in pieces that have it. ``sizes`` are the tokens' bytes in order,
    ``spans`` those of the pieces. A token over the border of a piece without loss has none."""
    has = np.concatenate([[0], np.cumsum(np.where(loss, spans, 0))])  # bytes with loss before each piece
    edge = np.concatenate([[0], np.cumsum(spans)])
    at = np.concatenate([[0], np.cumsum(sizes)])
    piece = np.searchsorted(edge, at, "right") - 1
    inside = np.append(loss, False)[piece]
    upto = has[piece] + np.where(inside, at - edge[piece], 0)
    return np.diff(upto) == sizes


def encode_pieces(pairs: BytePairs, texts: list[str], own: list[bool], special: dict[str, int]) -> bytes:
    """The tokens of parts as ``packed`` has them. The strings in ``special`` are single tokens in a template's own parts
    alone, so that nobody's text can pose as a marker; what lies between two of them is one text to the merges."""
    if not special:
        return pairs.encode_packed("".join(texts))
    markers = regex.compile("(" + "|".join(regex.escape(m) for m in sorted(special, key=len, reverse=True)) + ")")
    out, waiting = [], []

    def flush() -> None:
        out.append(pairs.encode_packed("".join(waiting)))
        waiting.clear()

    for text, mine in zip(texts, own, strict=True):
        for k, x in enumerate(markers.split(text) if mine else [text]):
            if k % 2:
                flush()
                out.append(packed([(special[x], len(x.encode()))]))
            else:
                waiting.append(x)
    flush()
    return b"".join(out)


def with_token_masks(df: DataFrame, pieces: str, ranks: str = RANKS, special: dict[str, int] | None = None) -> DataFrame:
    """``df`` plus token_ids and token_loss, arrays of one length, for a column of pieces as ``templates.pieces`` makes them. The
    pieces are one text to the tokens but for the markers in ``special`` (see ``encode_pieces``), so a token may cross their
    borders; see ``masked`` for what it counts as then. Null gives empty arrays."""
    shared = df.sparkSession.sparkContext.broadcast((read_ranks(df.sparkSession, ranks), {}, special or {}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, memo, markers = shared.value  # a worker has them once, so the memo is that of all its tasks
        pairs = BytePairs(table, memo)
        for b in (whole.slice(at, MASKED_ROWS) for whole in batches for at in range(0, whole.num_rows, MASKED_ROWS)):
            column = b.column(b.schema.names.index(pieces))
            counts, parts = column.value_lengths().fill_null(0).to_pylist(), column.flatten()
            texts, own, loss = (parts.field(n) for n in ("text", "own", "loss"))
            # Rows begin and end with pieces and tokens, so the masks of many are those of their pieces in one row.
            spans = pc.binary_length(texts)
            texts, own, rows, at = texts.to_pylist(), own.to_pylist(), [], 0
            for n in counts:
                rows.append(encode_pieces(pairs, texts[at : at + n], own[at : at + n], markers))
                at += n
            tokens = unpacked(rows)
            mask = masked(tokens[:, 1], spans.to_numpy(zero_copy_only=False), loss.to_numpy(zero_copy_only=False))
            yield pa.record_batch([*b.columns, _lists(rows, np.ascontiguousarray(tokens[:, 0])), _lists(rows, mask)], [*b.schema.names, "token_ids", "token_loss"])

    return df.mapInArrow(run, _added(df, StructField("token_ids", ArrayType(IntegerType())), StructField("token_loss", ArrayType(BooleanType()))))
