"""Toxicity by class-conditional Kneser-Ney models of the characters of words.

Two interpolated models, toxic and ordinary, count five-character strings of the training words (word ends are
characters too). Both back off to the same continuation counts of shorter strings, pooled over the classes, so a rare
expression is judged by the pieces it shares with known ones, and a string that neither class has says nothing. The
log-likelihood ratio of a word, of runs of words normalised by their length, and the share of words that tell, are weighed
by a logistic curve that is cross-fitted: each training fold is measured by the counts of the others.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import cut, free_names, id_hash, small_batches
from ._wordhash import mix

ORDER = 5
DISCOUNT = 0.75
#: Documented bound: about so many labelled rows of each class are used, chosen by hash. All their strings count.
MOST_ROWS = 10_000
FOLDS = 5
TRAINING = range(1, FOLDS)
RUN = 24  # words of a run whose mean is taken
#: Ratios from which a word counts as telling; the share of such words shows texts whose few toxic words stand apart.
TELLING = (1.2, 2.0, 3.0)
SMOOTH = 10  # words without a say that every text has besides, against chance in short ones
FEATURES = [f"f{i}" for i in range(3 + len(TELLING))]
PIECE = 1000  # characters of a word that are counted at once
SEED = 7
_PAD, _STOP = "\x02" * (ORDER - 1), "\x03"


def fold() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))


Packed = tuple[np.ndarray, np.ndarray]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the n characters from each place on (along the last axis)."""
    m = codes.shape[-1] - n + 1
    h = np.zeros((*codes.shape[:-1], m), np.uint64)
    for j in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[..., j : j + m] + np.uint64(1)
    return mix(h)


def packed(values: dict[str, float]) -> Packed:
    """Sorted hashes of strings of one length, and their values: 16 bytes a string where a worker holds them."""
    if not values:
        return np.empty(0, np.uint64), np.empty(0)
    n = len(next(iter(values)))
    keys = _hashes(_codes("".join(values)).reshape(len(values), n), n)[:, 0]
    order = np.argsort(keys)
    return keys[order], np.fromiter(values.values(), np.float64, len(values))[order]


def _found(table: Packed, keys: np.ndarray, other: np.ndarray | float) -> np.ndarray:
    known, values = table
    if not len(known):
        return np.broadcast_to(np.float64(other), keys.shape) if np.isscalar(other) else other
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, values[at], other)


class WordRatios(dict):
    """Word to log P(word | toxic) - log P(word | ordinary), worked out when first asked for; strings and contexts of strings
    as ``packed`` makes them."""

    LONGEST, MOST, AT_ONCE = 64, 100_000, 1 << 18

    def __init__(self, strings: Packed, contexts: Packed):
        super().__init__()
        self.strings, self.contexts = strings, contexts

    def work_out(self, words: list[str]) -> Iterator[float]:
        """The words' ratios, about AT_ONCE characters at a time."""
        begin = size = 0
        for i, w in enumerate(words):
            size += len(w) + ORDER
            if size >= self.AT_ONCE or i == len(words) - 1:
                part = words[begin : i + 1]
                codes = _codes("".join(f"{_PAD}{x}{_STOP}" for x in part))
                n = np.fromiter((len(x) + 1 for x in part), np.int64, len(part))  # strings of each word
                first = np.concatenate([[0], np.cumsum(n)])
                # Behind a word's strings are those that reach into the next one.
                at = np.arange(first[-1]) + np.repeat(np.arange(len(part)) * (ORDER - 1), n)
                value = _found(self.strings, _hashes(codes, ORDER)[at], _found(self.contexts, _hashes(codes, ORDER - 1)[at], 0.0))
                yield from np.add.reduceat(value, first[:-1]).tolist()
                begin, size = i + 1, 0

    def of(self, words: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self]
        if new and len(self) + len(new) > self.MOST:
            self.clear()
            new = list(dict.fromkeys(words))
        self.update(zip(new, self.work_out(new), strict=True))
        r = np.fromiter(map(self.__getitem__, words), np.float64, len(words))
        for w in new:
            if len(w) > self.LONGEST:
                del self[w]
        return r

    def features(self, text: str | None) -> tuple[float, ...]:
        """Mean ratio of all words, highest mean of a run of words, the mean of the two highest words, and the roots of the
        shares of words from each of TELLING on."""
        words = (text or "").lower().split()
        if not words:
            return (0.0,) * len(FEATURES)
        r = self.of(words)
        n = min(RUN, len(r))
        sums = np.concatenate([[0.0], np.cumsum(r)])
        runs = (sums[n:] - sums[:-n]) / n
        top = np.partition(r, len(r) - 2)[-2:].mean() if len(r) > 1 else r[0] / 2
        shares = [math.sqrt(np.count_nonzero(r > t) / (len(r) + SMOOTH)) for t in TELLING]
        return float(sums[-1] / len(r)), float(runs.max()), float(top), *shares


def kneser_ney(counts: dict[str, tuple[int, int]]):
    """(p, back) from counts of strings by class (0 ordinary, 1 toxic): p(c, hx) is the probability of x after h, back(c, h)
    the share of it that is left to shorter strings.

    P_c(x | h) = max(n_c(hx) - D, 0) / n_c(h) + D * kinds_c(h) / n_c(h) * Q(x | h'), with Q shared: the same recursion
    on numbers of distinct preceding characters, over both classes, down to a uniform start.
    """
    levels: list[Counter] = [Counter()]  # levels[k]: continuation counts of strings of length k
    longer = set(counts)
    for k in range(ORDER - 1, 0, -1):
        c = Counter(g[1:] for g in longer)
        levels.insert(1, c)
        longer = set(c)
    totals = [defaultdict(int) for _ in range(ORDER)]
    kinds = [defaultdict(int) for _ in range(ORDER)]
    for k in range(1, ORDER):
        for g, n in levels[k].items():
            totals[k][g[:-1]] += n
            kinds[k][g[:-1]] += 1
    base = 1.0 / (len(levels[1]) + 1)
    memo: dict[str, float] = {}

    def q(g: str) -> float:
        if not g:
            return base
        if g not in memo:
            k, h = len(g), g[:-1]
            n = totals[k].get(h, 0)
            low = q(g[1:])
            memo[g] = (max(levels[k].get(g, 0) - DISCOUNT, 0) + DISCOUNT * kinds[k][h] * low) / n if n else low
        return memo[g]

    n_h = [defaultdict(int), defaultdict(int)]
    k_h = [defaultdict(int), defaultdict(int)]
    for g, by_class in counts.items():
        for c in (0, 1):
            if by_class[c]:
                n_h[c][g[:-1]] += by_class[c]
                k_h[c][g[:-1]] += 1
    back = lambda c, h: DISCOUNT * k_h[c][h] / n_h[c][h] if h in n_h[c] else 1.0

    def p(c: int, g: str) -> float:
        h, n = g[:-1], counts[g][c] if g in counts else 0
        return (max(n - DISCOUNT, 0) / n_h[c][h] if h in n_h[c] else 0.0) + back(c, h) * q(g[1:])

    return p, back


def kneser_ney_ratios(counts: dict[str, tuple[int, int]], wanted: list[str] | None = None) -> tuple[dict[str, float], dict[str, float]]:
    """Log ratios, toxic to ordinary, of seen strings and of contexts of unseen ones; only those that the strings ``wanted``
    need, if they are given."""
    p, back = kneser_ney(counts)
    wanted = counts if wanted is None else wanted
    seen = {g[:-1] for g in counts}
    strings = {g: math.log(p(1, g) / p(0, g)) for g in wanted if g in counts}
    return strings, {h: math.log(back(1, h) / back(0, h)) for h in {g[:-1] for g in wanted} if h in seen}


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic, fold) to counts of words by class, one row per piece of a word, fold and batch. A word goes with its
    ends; a long one in pieces that overlap, so that each of its strings is in one of them."""

    def pieces(word: str) -> Iterator[str]:
        s = f"{_PAD}{word}{_STOP}"
        for i in range(0, len(s) - ORDER + 1, PIECE):
            yield s[i : i + PIECE + ORDER - 1]

    for batch in batches:
        c = (Counter(), Counter())
        for text, toxic, k in zip(*(batch.column(i) for i in range(3)), strict=True):
            fold_ = k.as_py()
            c[1 if toxic.as_py() else 0].update((x, fold_) for w in (text.as_py() or "").lower().split() for x in pieces(w))
        keys = list({*c[0], *c[1]})
        yield pa.record_batch(
            [
                pa.array([w for w, _ in keys], pa.string()), pa.array([k for _, k in keys], pa.int64()),
                pa.array([c[0][x] for x in keys], pa.int64()), pa.array([c[1][x] for x in keys], pa.int64()),
            ],
            ["s", "fold", "n0", "n1"],
        )


def _string_counts(fit: DataFrame) -> tuple[list[str], np.ndarray]:
    """All strings, and their counts by training fold and class."""
    cells = [f"n{c}_{k}" for k in TRAINING for c in (0, 1)]
    words = fit.select("text", "toxic", F.col("fold").cast("long")).mapInArrow(_word_counts, "s string, fold long, n0 long, n1 long")
    padded = words.groupBy("s").agg(*[F.sum(F.when(F.col("fold") == k, F.col(f"n{c}")).otherwise(0)).alias(f"n{c}_{k}") for k in TRAINING for c in (0, 1)])
    at = F.explode(F.sequence(F.lit(1), F.char_length("s") - ORDER + 1))
    strings = padded.withColumn("at", at).groupBy(F.substring("s", F.col("at"), F.lit(ORDER)).alias("g"))
    found, counts = [], array("q")
    for row in strings.agg(*[F.sum(n).alias(n) for n in cells]).toLocalIterator():
        found.append(row[0])
        counts.extend(row[1:])
    return found, np.frombuffer(counts, np.int64).reshape(len(found), len(TRAINING), 2) if found else np.zeros((0, len(TRAINING), 2), np.int64)


def _ratios_without(strings: list[str], counts: np.ndarray, held: int | None) -> tuple[Packed, Packed]:
    """Ratios from the training folds other than ``held``, as its own strings need them; from all of them if these lack a
    class."""
    n, wanted = counts.sum(1), None
    if held is not None:
        wanted = [strings[i] for i in np.flatnonzero(counts[:, held - 1].any(1)).tolist()]
        others = n - counts[:, held - 1]
        n = others if others.sum(0).all() else n
    seen = np.flatnonzero(n.any(1))
    return tuple(map(packed, kneser_ney_ratios({strings[i]: (a, b) for i, (a, b) in zip(seen.tolist(), n[seen].tolist(), strict=True)}, wanted)))


def _feature_rows(shared, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = WordRatios(*shared.value[:2])
        for batch in batches:
            rows = [ratios.features(t.as_py()) for t in batch.column("text")]
            cols = [pa.array([r[k] for r in rows], pa.float64()) for k in range(len(FEATURES))]
            yield pa.record_batch([*[batch.column(c) for c in kept], *cols], [*kept, *FEATURES])

    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(means, scales, weights with the constant last), by Newton steps on standardised features."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + ridge * len(y) * np.r_[w[:-1], 0]
        hess = (z * (p * (1 - p))[:, None]).T @ z + ridge * len(y) * np.diag(np.r_[np.ones(len(w) - 1), 1e-6])
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS):
    """Fit on labelled rows outside fold 0; returns a broadcast (string ratios, context ratios, logistic or None).

    A document with several labels is toxic if one says so. Without rows of both classes nothing can be learned: the
    logistic is None. It is fitted on all training folds, each measured by the counts of the other ones (where these lack
    a class, by all); the result has the counts of all.
    """
    with small_batches(docs.sparkSession):
        return _trained(docs, labels, most_rows)


def _trained(docs: DataFrame, labels: DataFrame, most_rows: int):
    sc = docs.sparkSession.sparkContext
    marked = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.filter(fold() != 0).withColumns({"fold": fold(), "h": id_hash(SEED, "doc_id")})
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if not (sizes.get(0) and sizes.get(1)):
        return sc.broadcast((packed({}), packed({}), None))
    share = F.when(F.col("toxic") == 1, F.lit(min(1.0, most_rows / sizes[1]))).otherwise(F.lit(min(1.0, most_rows / sizes[0])))
    sample = marked.filter(F.col("h") < share * F.lit(float(1 << 63))).select("doc_id", "toxic", "fold")
    # About 2 * most_rows rows of three numbers: broadcast whatever the corpus's size. Their texts are read five times.
    rows = cut(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"), "fold"))
    found, counts = _string_counts(rows)
    x, y = [], []
    for k in TRAINING:
        model = sc.broadcast(_ratios_without(found, counts, k))
        held = rows.filter(F.col("fold") == k).select("text", "toxic").mapInArrow(_feature_rows(model, ["toxic"]), "toxic int, " + ", ".join(f"{f} double" for f in FEATURES))
        for r in held.toLocalIterator():
            x.append(tuple(r[f] for f in FEATURES))
            y.append(r["toxic"])
        model.destroy()
    order = sorted(range(len(y)), key=lambda i: (x[i], y[i]))  # the same sums in every run
    logistic = None
    if len(set(y)) == 2:
        logistic = fit_logistic(np.array([x[i] for i in order]), np.array([y[i] for i in order], float))
    return sc.broadcast((*_ratios_without(found, counts, None), logistic))


def score_documents(docs: DataFrame, model) -> DataFrame:
    """``docs`` plus ``score``, from ``text`` alone; 0 where nothing could be learned. Null counts as empty. Where
    ``docs`` has a column of that name, the new one is ``score_``."""
    return _scored(docs, model, *free_names(docs, "score"))


def _scored(docs: DataFrame, model, added: str) -> DataFrame:
    kept = docs.schema.fields
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings, contexts, logistic = model.value
        ratios = WordRatios(strings, contexts)
        for batch in batches:
            texts = batch.column(names.index("text"))
            scores = np.zeros(len(texts))
            if logistic is not None and len(texts):
                mean, scale, w = logistic
                x = (np.array([ratios.features(t.as_py()) for t in texts]) - mean) / scale
                scores = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -500, 500)))
            yield pa.record_batch([*[batch.column(k) for k in range(len(names))], pa.array(scores)], [*names, added])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], f"{added} double"])
    return docs.mapInArrow(run, schema)


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``, in terms of doc_id and text alone. A null doc_id is not held out; null and empty texts get
    the score of a text without words; without labels of both classes all scores are 0."""
    scored = score_documents(docs.select("doc_id", "text"), train(docs, labels))
    held_out = F.coalesce(fold() == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text scores 0.5 or more. All columns, whatever their names, and all other rows stay,
    null and empty texts among them unless the labels speak against texts without words; without labels of both classes
    all rows stay."""
    (score,) = free_names(docs, "score")
    return _scored(docs, train(docs, labels), score).filter(F.col(score) < 0.5).drop(score)
