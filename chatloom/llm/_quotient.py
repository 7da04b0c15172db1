"""Counting quotient filters: lossless counts of 64-bit keys in a compact sorted form, whose merge is a merge of sorted runs.

A key goes through an invertible permutation. Its first bits name the shard, the next ones the quotient, and what is left,
the remainder, is stored whole, so the filter gives every key back and counts it exactly.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

from ._wordhash import mix

#: Keys that a counter or a merge gathers before it sums them up: some 110 bytes each at the peak, two tasks beside a JVM.
HELD = 1 << 19
_INVERSES = [np.uint64(pow(x, -1, 1 << 64)) for x in (0x94D049BB133111EB, 0xBF58476D1CE4E5B9)]


def unmix(h: np.ndarray) -> np.ndarray:
    """The inverse of ``mix``."""
    h = h ^ (h >> np.uint64(31)) ^ (h >> np.uint64(62))
    h = h * _INVERSES[0]
    h = h ^ (h >> np.uint64(27)) ^ (h >> np.uint64(54))
    h = h * _INVERSES[1]
    return h ^ (h >> np.uint64(30)) ^ (h >> np.uint64(60))


def counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct permuted keys with their summed counts."""
    order = None if counts is None else np.argsort(keys, kind="stable")
    keys = np.sort(keys) if order is None else keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    at = np.flatnonzero(new)
    if order is None:
        return keys[at], np.diff(np.append(at, len(keys)))
    return keys[at], np.add.reduceat(counts[order], at) if len(at) else counts


def pack(keys: np.ndarray, counts: np.ndarray, shard_bits: int) -> bytes:
    """A filter of sorted permuted keys of one shard: the number of entries, the bits of the quotient, for each quotient its
    entries in unary, the remainders in whole bytes, and counts of one byte, with those of 255 and more behind them."""
    bits = max(1, min(63 - shard_bits, int(len(keys)).bit_length()))
    rest = 64 - shard_bits - bits
    inside = keys & np.uint64((1 << (64 - shard_bits)) - 1)
    quotient = (inside >> np.uint64(rest)).astype(np.int64)
    runs = np.zeros(len(keys) + (1 << bits), bool)
    runs[quotient + np.arange(len(keys))] = True  # each quotient ends with a zero
    width = -(-rest // 8)
    remainder = (inside & np.uint64((1 << rest) - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    large = counts >= 255
    head = np.array([len(keys), bits, int(large.sum())], "<i8").tobytes()
    return b"".join([head, np.packbits(runs).tobytes(), remainder.tobytes(), np.where(large, 255, counts).astype(np.uint8).tobytes(), counts[large].astype("<i8").tobytes()])


def unpack(raw: bytes, shard: int, shard_bits: int) -> tuple[np.ndarray, np.ndarray]:
    n, bits, n_large = (int(x) for x in np.frombuffer(raw, "<i8", 3))
    rest, at = 64 - shard_bits - bits, 24
    size = -(-(n + (1 << bits)) // 8)
    runs = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, size, at), count=n + (1 << bits)))
    quotient, at, width = (runs - np.arange(n)).astype(np.uint64), at + size, -(-rest // 8)
    whole = np.zeros((n, 8), np.uint8)
    whole[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(n, width)
    counts = np.frombuffer(raw, np.uint8, n, at + n * width).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw, "<i8", n_large, at + n * width + n)
    top = np.uint64(shard << (64 - shard_bits)) if shard_bits else np.uint64(0)
    return top | (quotient << np.uint64(rest)) | whole.view("<u8").ravel(), counts


def merged(parts: Iterable[tuple[np.ndarray, np.ndarray]], held: int = HELD) -> tuple[np.ndarray, np.ndarray]:
    """The merge of sorted (keys, counts): parts gather up to ``held`` keys beside what is merged already."""
    keys, counts, waiting = np.empty(0, np.uint64), np.empty(0, np.int64), []

    def merge() -> tuple[np.ndarray, np.ndarray]:
        return counted(np.concatenate([keys, *[k for k, _ in waiting]]), np.concatenate([counts, *[c for _, c in waiting]]))

    for part in parts:
        waiting.append(part)
        if sum(len(k) for k, _ in waiting) > max(held, len(keys)):
            keys, counts = merge()
            waiting = []
    return merge()


def by_shard(keys: np.ndarray, counts: np.ndarray, shard_bits: int) -> Iterator[tuple[int, bytes]]:
    """(shard, filter) of sorted permuted keys."""
    shards = (keys >> np.uint64(64 - shard_bits)).astype(np.int64)
    at = np.flatnonzero(np.diff(shards, prepend=-1))
    for a, b in zip(at, np.append(at, len(keys))[1:], strict=True):
        yield int(shards[a]), pack(keys[a:b], counts[a:b], shard_bits)


class ShardedCounter:
    """Counts keys one array at a time; ``full`` filters are passed on, so that it never holds much more than ``held``."""

    def __init__(self, shard_bits: int, held: int = HELD):
        self.shard_bits, self.held = shard_bits, held
        self.fresh: list[np.ndarray] = []
        self.keys, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def add(self, keys: np.ndarray) -> Iterator[tuple[int, bytes]]:
        self.fresh.append(mix(keys))
        if sum(map(len, self.fresh)) > self.held:
            self._sum()
            if len(self.keys) > self.held // 2:
                yield from self.rest()

    def _sum(self) -> None:
        if self.fresh:
            new = counted(np.concatenate(self.fresh))
            self.keys, self.counts = merged([(self.keys, self.counts), new])
            self.fresh = []

    def rest(self) -> Iterator[tuple[int, bytes]]:
        self._sum()
        yield from by_shard(self.keys, self.counts, self.shard_bits)
        self.keys, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)
