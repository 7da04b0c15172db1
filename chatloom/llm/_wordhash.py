"""Vectorised words and word n-grams of whole texts, for use inside Arrow tasks.

A word's hash is a polynomial over a random value per byte, taken from prefix sums modulo 2**64 and mixed afterwards;
an n-gram's hash combines those of its words. Texts are worked on in pieces of about a megabyte, whole texts each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix((np.arange(1, 257, dtype=np.uint64)) * np.uint64(_BASE))
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE + PIECE // 4)
        tables = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            tables.append(np.cumprod(p, dtype=np.uint64))
        _powers[:] = tables
    return _powers


#: Separators: the six ASCII white-space bytes; or all ASCII bytes but digits and letters.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
NOT_WORD = np.zeros(256, bool)
NOT_WORD[:128] = [not chr(b).isalnum() for b in range(128)]


class Words:
    """The words of a few texts: ``start`` and ``end`` in ``data``, ``hash``, and for text number i the words first[i] to
    first[i + 1]. ``data`` holds the texts one after the other, text i from at[i] to at[i + 1]."""

    def __init__(self, data: bytes | np.ndarray, at: np.ndarray, separators: np.ndarray):
        buf = np.frombuffer(data, np.uint8)
        self.data = buf
        inside = np.zeros(len(buf) + 2, bool)
        inside[1:-1] = ~separators[buf]
        begins, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
        # Where a text begins, the word before it ends.
        edge = at[1:-1]
        both = edge[inside[edge] & inside[edge + 1]]
        begins[both] = ends[both] = True
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends)
        powers, inverse = _power_tables(len(buf))
        sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_BYTE[buf] * powers[: len(buf)], out=sums[1:])
        raw = (sums[self.end] - sums[self.start]) * inverse[self.start]
        self.hash = mix(raw + (self.end - self.start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        self.first = np.searchsorted(self.start, at)

    @classmethod
    def of(cls, texts: list[bytes], separators: np.ndarray) -> Words:
        return cls(b"".join(texts), np.cumsum([0, *map(len, texts)]), separators)

    def grams(self, n: int) -> np.ndarray:
        """Hashes of n consecutive words from each word on; those over the end of a text mean nothing."""
        m = max(0, len(self.hash) - n + 1)
        total = np.zeros(m, np.uint64)
        for j in range(n):
            total = total * np.uint64(_BASE) + self.hash[j : j + m]
        return mix(total)

    def gram_text(self, i: int, n: int) -> bytes:
        return b" ".join(self.data[self.start[j] : self.end[j]].tobytes().lower() for j in range(i, i + n))


def pieces(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, bytes of some texts, where each begins and the last ends) for a column of strings, about
    PIECE bytes or one text at a time, as they lie in memory; null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + PIECE, "right")) - 1)
        yield begin, data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]
        begin = end


def _short(hashes: np.ndarray) -> np.ndarray:
    """All words of a text as one shingle."""
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for x in hashes:
            h = h * np.uint64(_BASE) + x
        h += np.uint64(len(hashes))
    return mix(np.array([h], np.uint64))


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct k-word shingles as uint64; all words as one if they are fewer; none if none."""
    for _, data, at in pieces(texts):
        w = Words(data, at, SPACES)
        grams, first = w.grams(k), w.first.tolist()
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= k:
                s = grams[a : b - k + 1]  # its part of the piece, sorted in place
                s.sort()
                new = np.empty(len(s), bool)
                new[0] = True
                np.not_equal(s[1:], s[:-1], out=new[1:])
                yield s[new]
            elif b > a:
                yield _short(w.hash[a:b])
            else:
                yield np.empty(0, np.uint64)


def shingles(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The shingles of all texts, piece by piece, repeated ones too."""
    for _, data, at in pieces(texts):
        w = Words(data, at, SPACES)
        inside = np.ones(len(w.hash), bool)
        for d in range(1, k):  # the last words of a text begin no shingle
            inside[w.first[1:][w.first[1:] - d >= w.first[:-1]] - d] = False
        n = np.diff(w.first)
        few = np.flatnonzero((n > 0) & (n < k))
        grams = w.grams(k)
        yield np.concatenate([grams[inside[: len(grams)]], *[_short(w.hash[w.first[i] : w.first[i + 1]]) for i in few]])
