"""Secret scans: rule matches, plus high-entropy strings found by a sliding window.

Everything is column expressions, so a scan is one narrow stage without a shuffle, whatever the input's size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import free_names, text_or_empty

# The three rules. ``assign`` ignores the case of the ASCII letters in its first group.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A maximal run that is long enough is the same as any maximal run with its length tested afterwards.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")
MATCHES = 128

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: A candidate is a maximal run over ALPHABET with a digit and a letter.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
CLASSES = {"digits": "09", "lower": "af", "upper": "AF"}
#: Bits a window must reach, by the character class of the window: hex of one case with digits and letters, or mixed.
HEX_BITS, MIXED_BITS = 3.0, 3.75
#: Counts of COUNT_BITS bits, PER_WORD in a 64-bit number; windows are shorter than 2**COUNT_BITS. SCALE makes logarithms whole.
COUNT_BITS, PER_WORD, SCALE = 6, 10, 1 << 32
#: Strings that look random but are no secrets: UUIDs, dotted or slashed words with a number.
ALLOWED = r"(?i)^[/_=-]*([0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}|[A-Za-z]++(?:[/_=-]++(?:[A-Za-z]++|[0-9]{1,4}+))++)[/_=-]*$"
#: Parts between separators that are none: placeholders, alphabets.
ALLOWED_PART = r"(?i)(?<![^/_=-])[^/_=-]*?(?:example|sample|dummy|placeholder|changeme|x{6,}|abcdefgh|0123456789)[^/_=-]*"


def _spans(text: Column, pattern: str, rank: int, keep=None) -> Column:
    """array<struct<start, rank, end, match>> of the leftmost non-overlapping matches, in code points.

    The pieces between matches and the matches themselves alternate, so running lengths give the places: in blocks of
    MATCHES first, as an array that grows is copied at each step, and then over the blocks."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    kind = "array<struct<start:int,rank:int,end:int,match:string>>"

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["before"])
        end = start + F.char_length(x["match"])
        one = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), x["match"].alias("match")))
        more = one if keep is None else F.when(keep(x["match"]), one).otherwise(F.array().cast(kind))
        return F.struct(end.alias("at"), F.concat(acc["spans"], more).cast(kind).alias("spans"))

    def of_blocks(all_: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / MATCHES).cast("int"))
        done = F.transform(numbers, lambda b: F.aggregate(F.slice(all_, b * MATCHES + 1, F.lit(MATCHES)), start, step))
        placed = F.aggregate(done, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<at:int,spans:{kind}>>").alias("out")), append)["out"]
        return F.flatten(F.transform(placed, lambda p: F.transform(p["spans"], lambda y: moved(y, p["at"]))))

    def append(acc: Column, p: Column) -> Column:
        one = F.array(F.struct(acc["at"].alias("at"), p["spans"].alias("spans")))
        return F.struct((acc["at"] + p["at"]).alias("at"), F.concat(acc["out"], one).cast(f"array<struct<at:int,spans:{kind}>>").alias("out"))

    def moved(y: Column, by: Column) -> Column:
        return F.struct((y["start"] + by).alias("start"), y["rank"].alias("rank"), (y["end"] + by).alias("end"), y["match"].alias("match"))

    zipped = F.zip_with(pieces, found, lambda b, m: F.struct(b.alias("before"), m.alias("match")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans"))
    none = F.array().cast(kind)
    # Nearly all texts have no match; they skip the second pass of the pattern.
    return F.when(F.size(found) > 0, F.get(F.transform(F.array(zipped), of_blocks), F.lit(0)).cast(kind)).otherwise(none)


def _hot_part(s: Column, window: int) -> Column:
    """struct<first, last>: from the first to the last position covered by windows that reach their class's entropy.

    The characters become codes once. Each step adds one code to the counts and takes one away; with g(c) = c*log2(c) kept
    as a running sum, a window's entropy is log2(w) - sum/w. Counts are PER_WORD to a number, sums are whole numbers."""
    up = _numbers(_g(c + 1) - _g(c) for c in range(window + 1))
    down = _numbers(_g(max(c - 1, 0)) - _g(c) for c in range(window + 1))
    code = _numbers((ALPHABET.find(chr(b)) for b in range(128)), "int")
    shift = _numbers((c % PER_WORD * COUNT_BITS for c in range(len(ALPHABET))), "int")
    one = _numbers(1 << c % PER_WORD * COUNT_BITS for c in range(len(ALPHABET)))
    most = {b: math.floor((math.log2(window) - b) * window * SCALE) + window for b in (HEX_BITS, MIXED_BITS)}

    def count(counts: Column, c: Column) -> Column:
        return F.call_function("shiftright", F.get(counts, c["slot"]), c["shift"]).bitwiseAND(F.lit((1 << COUNT_BITS) - 1)).cast("int")

    def among(c: Column, first: str, last: str) -> Column:
        return F.when(c["code"].between(ALPHABET.index(first), ALPHABET.index(last)), 1).otherwise(0)

    def step(acc: Column, x: Column) -> Column:
        new, old, i = x["new"], x["old"], acc["at"] + 1
        same = F.coalesce(new["code"] == old["code"], F.lit(False))
        change = F.get(up, count(acc["counts"], new)) + F.coalesce(F.get(down, count(acc["counts"], old)), F.lit(0))
        add = lambda k: F.when(new["slot"] == k, new["one"]).otherwise(0)
        less = lambda k: F.when(old["slot"] == k, old["one"]).otherwise(0)
        counts = F.when(same, acc["counts"]).otherwise(F.transform(acc["counts"], lambda c, k: c + add(k) - less(k)))
        total = F.when(same, acc["total"]).otherwise(acc["total"] + change)
        classes = [(acc[n] + among(new, *ends) - among(old, *ends)).alias(n) for n, ends in CLASSES.items()]
        return F.struct(i.alias("at"), counts.alias("counts"), total.alias("total"), *classes, *_seen(acc, window, most))

    zero = F.struct(
        F.lit(0).alias("at"),
        F.array_repeat(F.lit(0).cast("long"), -(-len(ALPHABET) // PER_WORD)).alias("counts"),
        F.lit(0).cast("long").alias("total"),
        *[F.lit(0).alias(n) for n in CLASSES],
        F.lit(0).alias("first"),
        F.lit(0).alias("last"),
    )
    codes = F.transform(F.transform(F.split(s, ""), lambda c: F.get(code, F.ascii(c))), lambda c: F.struct(
        c.alias("code"), F.floor(c / PER_WORD).cast("int").alias("slot"), F.get(shift, c).alias("shift"), F.get(one, c).alias("one")
    ))
    # As elements of arrays of one, codes and the fold's end are worked out once.
    before = lambda c: F.slice(F.concat(F.array_repeat(F.lit(None), window), c), F.lit(1), F.size(c))
    pairs = lambda c: F.zip_with(c, before(c), lambda n, o: F.struct(n.alias("new"), o.alias("old")))
    ends = F.transform(F.array(codes), lambda c: F.aggregate(pairs(c), zero, step))
    return F.get(F.transform(ends, lambda acc: F.struct(*_seen(acc, window, most))), F.lit(0))


def _g(c: int) -> int:
    return round(c * math.log2(c) * SCALE) if c else 0


def _numbers(values, kind: str = "long") -> Column:
    return F.array(*[F.lit(v).cast(kind) for v in values])


def _seen(acc: Column, window: int, most: dict[float, int]) -> tuple[Column, Column]:
    """first and last after the window that ends at acc.at, which the next step, or the end, looks at."""
    one_case = (acc["digits"] + acc["lower"] == window) | (acc["digits"] + acc["upper"] == window)
    is_hex = (acc["digits"] > 0) & (acc["digits"] < window) & one_case
    hot = (acc["at"] >= window) & (acc["total"] <= F.when(is_hex, most[HEX_BITS]).otherwise(most[MIXED_BITS]))
    first = F.when(hot & (acc["first"] == 0), acc["at"] - window + 1).otherwise(acc["first"])
    return first.alias("first"), F.when(hot, acc["at"]).otherwise(acc["last"]).alias("last")


def _pieces(x: Column, base: Column) -> Column:
    """array<struct<start, match>>: what base spans and allowed parts leave of the candidate x."""
    kind = "array<struct<start:int,match:string>>"
    ends = lambda at, y: F.struct((at + y["start"]).alias("start"), (at + y["end"]).alias("end"))
    near = F.filter(base, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))
    allowed = _spans(x["match"], ALLOWED_PART, 0)
    out = F.sort_array(F.concat(F.transform(near, lambda y: ends(F.lit(0), y)), F.transform(allowed, lambda y: ends(x["start"], y))))

    def piece(start: Column, end: Column) -> Column:
        match = F.substring(x["match"], start - x["start"] + 1, end - start)
        one = F.array(F.struct(start.alias("start"), match.alias("match"))).cast(kind)
        return F.when(end > start, one).otherwise(F.array().cast(kind))

    def step(acc: Column, y: Column) -> Column:
        return F.struct(F.greatest(acc["at"], y["end"]).alias("at"), F.concat(acc["out"], piece(acc["at"], y["start"])).cast(kind).alias("out"))

    left = F.aggregate(out, F.struct(x["start"].alias("at"), F.array().cast(kind).alias("out")), step)
    return F.concat(left["out"], piece(left["at"], x["end"]))


def _entropy_spans(text: Column, base: Column, window: int) -> Column:
    found = _spans(text, CANDIDATE, KINDS.index("entropy"), lambda m: ~m.rlike(ALLOWED))
    pieces = F.flatten(F.transform(found, lambda x: _pieces(x, base)))
    pieces = F.filter(pieces, lambda x: (F.char_length(x["match"]) >= window) & ~x["match"].rlike(ALLOWED))
    hot = F.transform(pieces, lambda x: F.struct(x["start"].alias("start"), _hot_part(x["match"], window).alias("hot")))
    hot = F.filter(hot, lambda x: x["hot"]["first"] > 0)
    return F.transform(
        hot,
        lambda x: F.struct(
            (x["start"] + x["hot"]["first"] - 1).alias("start"),
            F.lit(KINDS.index("entropy")).alias("rank"),
            (x["start"] + x["hot"]["last"]).alias("end"),
        ),
    )


def _joined(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(name, x["rank"]), x["start"].cast("string"), x["end"].cast("string"))),
        ",",
    )


def scan_secrets(df: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """Add ``secret_base`` and ``secret_spans`` (arrays of struct<start, rank, end>; rank indexes KINDS) to ``df``. Where
    ``df`` has columns of these names, the new ones get underscores behind theirs.

    Base spans are the whole matches of the three rules whose value is long enough. What these and the parts on the
    allow-list leave of a candidate string is searched piece by piece: entropy spans are the parts whose windows reach
    the entropy of their own characters' class. Null and empty texts have no spans; all columns and rows stay.
    """
    base_name, spans_name = free_names(df, "secret_base", "secret_spans")
    t = text_or_empty(F.col(text))
    base = F.concat(
        _spans(t, ASSIGN, 0, lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 2)) >= 6),
        _spans(t, ACCESS, 1),
        _spans(t, HEX, 2),
    )
    bare = lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end"))
    df = df.withColumn(base_name, F.sort_array(F.transform(base, bare)))
    extra = _entropy_spans(t, F.col(base_name), window)
    return df.withColumn(spans_name, F.sort_array(F.concat(base_name, extra)))


def redact_secrets(df: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``df`` with every found span replaced by ``mask``; overlapping spans are masked once. Null texts stay null, and all
    other columns, whatever their names."""
    found = scan_secrets(df.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("text")))
    t = F.col("text")
    kind = "array<string>"
    step = lambda acc, x: F.struct(
        F.greatest(acc["at"], x["end"]).alias("at"),
        F.when(x["start"] >= acc["at"], F.concat(acc["out"], F.array(F.substring(t, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mask))).cast(kind))
        .otherwise(acc["out"])
        .alias("out"),
    )
    done = F.aggregate("secret_spans", F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")), step)
    whole = F.concat(F.array_join(done["out"], ""), F.substring(t, done["at"] + 1, F.char_length(t)))
    new = F.when(F.size("secret_spans") > 0, whole).otherwise(t)
    return found.select(*[(new if c == text else F.col(f"row.`{c}`")).alias(c) for c in df.columns])


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts, digest and spans for each row of ``docs``, in terms of doc_id and text alone; null counts as empty."""
    found = scan_secrets(docs.select("doc_id", "text"))
    n = lambda rank: F.size(F.filter("secret_base", lambda x: x["rank"] == rank)).cast("long")
    return found.select(
        "doc_id",
        n(0).alias("n_assign"),
        n(1).alias("n_access"),
        n(2).alias("n_hex"),
        F.sha2(_joined(F.col("secret_base")), 256).alias("base_sha256"),
        _joined(F.col("secret_spans")).alias("spans"),
    )
