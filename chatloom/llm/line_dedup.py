"""Line dedup by a deletion-neighbourhood join.

Two lines are the same when their words are, white space and case aside, and near when one word added, removed or
replaced turns one into the other and that is little enough of the longer one: a similarity of 80 percent by default, so
with five words or more. A near pair agrees after at most one deletion on either side, so equal variants
(the line itself and the line without each of its words) find all pairs. Before variants are made, lines that share
neither half with another line are put aside: one edit leaves the first or the second half of both lines equal, so
this loses no pair, and most lines end there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import cut, text_or_empty

#: White space within a line that is more than one space.
GAPS = r"[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*|\x20[\x20\x09\x0B-\x0D]+"
#: A line with words, from its first word on.
LINE = r"[^\x20\x09-\x0D][^\x0A]*"
#: Least similarity of near lines: 100 less the share of the longer line's words that an edit changes.
PERCENT = 80


def _part(line: str, n: Column) -> Column:
    """The first n words of a normal form, or the last -n."""
    return F.call_function("substring_index", F.col(line), F.lit(" "), n)


def _words_less(line: str, n: str, i: Column) -> Column:
    """The line without its word number i, counted from 0."""
    before, after = _part(line, i), _part(line, i + 1 - F.col(n))
    return F.concat_ws(" ", F.nullif(before, F.lit("")), F.nullif(after, F.lit("")))


def text_lines(docs: DataFrame) -> DataFrame:
    """One row per line with words: where it stands, its normal form ``line``, its number of words and the form's keys.
    Texts are hashed and put into normal form before they are split, so once each: without ``outer``, Spark filters on the size
    of the list of lines first, and makes it twice. A list always has a line."""
    t = text_or_empty("text")
    whole = docs.select("doc_id", F.xxhash64(t).alias("th"), _clean_lines(t).alias("lines"))
    return (
        whole.select("doc_id", "th", F.posexplode_outer("lines").alias("line_no", "raw"))
        .select(F.struct("doc_id", "th", "line_no").alias("pos"), F.trim("raw").alias("line"))
        .filter("line <> ''")
        .withColumns({"k1": F.xxhash64("line"), "k2": F.xxhash64(F.lit(7), "line")})
        .withColumn("n", _words("line"))
    )


def _clean_lines(text: Column) -> Column:
    return F.split(F.lower(F.regexp_replace(text, GAPS, " ")), "\n", -1)


def _words(line: str) -> Column:
    """Number of words of a normal form."""
    return F.char_length(line) - F.char_length(F.replace(F.col(line), F.lit(" "), F.lit(""))) + 1


def _lines_at(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (with ``first``, the place of a line) plus the line's normal form and number of words, once for each row of
    ``docs`` that is the same. Each document meets the list of its wanted lines, so only whole texts move, once; where
    one line is in very many documents, its first place alone is looked up."""
    rest = [c for c in wanted.columns if c != "first"]
    per_doc = wanted.groupBy(F.col("first.doc_id").alias("of"), F.col("first.th").alias("oth")).agg(
        F.collect_list(F.struct(F.col("first.line_no").alias("at"), *rest)).alias("wanted")
    )
    t = text_or_empty("text")
    whole = docs.select("doc_id", F.xxhash64(t).alias("th"), _clean_lines(t).alias("lines"))
    met = whole.join(per_doc, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("th") == F.col("oth")))
    told = F.transform("wanted", lambda w: F.struct(w.at.alias("line_no"), *[w[c].alias(c) for c in rest], F.trim(F.get("lines", w.at)).alias("line")))
    lines = met.select("doc_id", "th", F.inline_outer(told))
    return lines.select(F.struct("doc_id", "th", "line_no").alias("first"), *rest, "line", _words("line").alias("n"))


def _halves(long_enough: Column) -> dict[str, Column]:
    """Keys of the first and second halves; of lines with an odd number of words, both ways to halve."""
    low, odd = F.expr("n div 2").cast("int"), F.col("n") % 2 == 1
    half = lambda side, n: F.xxhash64(F.lit(side), _part("line", n))
    return {
        "front_low": F.when(long_enough, half(0, low)),
        "front_high": F.when(long_enough & odd, half(0, low + 1)),
        "back_low": F.when(long_enough, half(1, -low)),
        "back_high": F.when(long_enough & odd, half(1, -low - 1)),
    }


def line_decisions(docs: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(lines, fates): every line's place and key, and for each distinct line that has copies or is near an earlier one
    its first place and whether it goes altogether. Rows of ``docs`` that repeat doc_id and text count as one document.

    Texts are scanned twice: once for keys, once for the lines that may be near another. All else moves keys."""
    longest = -(-100 // (100 - percent))  # words of the longer line of a near pair, at least
    halves = _halves(F.col("n") >= longest - 1)
    keyed = cut(text_lines(docs).select("pos", "k1", "k2", *[c.alias(h) for h, c in halves.items()]))
    lines = keyed.select("pos", "k1", "k2")
    distinct = cut(keyed.groupBy("k1", "k2").agg(F.min("pos").alias("first"), F.count("*").alias("copies"), *[F.min(h).alias(h) for h in halves]))
    sides = [F.struct(F.lit(h.startswith("front")).alias("front"), F.col(h).alias("half")) for h in halves]
    sides = distinct.filter("front_low IS NOT NULL").select("k1", "k2", F.inline(F.array(*sides))).filter("half IS NOT NULL")
    shared = cut(sides.groupBy("half").agg(F.count("*").alias("c")).filter("c > 1").select("half"))
    likely = sides.join(shared, "half", "left_semi").groupBy("k1", "k2").agg(F.max("front").alias("front"), F.max(~F.col("front")).alias("back"))
    wanted = distinct.select("k1", "k2", "first").join(likely, ["k1", "k2"])
    texts = _lines_at(docs, wanted).groupBy("k1", "k2").agg(*[F.min(c).alias(c) for c in ("first", "line", "n", "front", "back")])
    near = _near_lines(cut(texts), longest)
    fates = (
        distinct.join(near.withColumn("near", F.lit(True)), ["k1", "k2"], "left")
        .filter("copies > 1 OR near")
        .select("k1", "k2", "first", F.coalesce("near", F.lit(False)).alias("near"))
    )
    return lines, cut(fates)


def _near_lines(lines: DataFrame, longest: int) -> DataFrame:
    """Keys of the lines that are one word away from an earlier line.

    Lines that lack the same word of the same variant differ in that word alone; a variant that is itself a line is one
    word shorter. In each such set only the earliest line matters, so sets are aggregated, never paired up. Where only
    the first half is shared with another line, the edit lies in the rest, and the other way round, so words of the
    shared half alone need no deletion. Variants of one line only are put aside before anything else moves.
    """
    low = F.expr("n div 2").cast("int")
    begin, end = F.when(F.col("back"), 0).otherwise(low), F.when(F.col("front"), F.col("n").cast("int")).otherwise(F.col("n").cast("int") - low) - 1
    # A line of one word less than the longest is near longer ones only, so it stands for itself.
    places = F.when(F.col("n") >= longest, F.sequence(begin, end)).otherwise(F.array().cast("array<int>"))
    v = lines.select("k1", "k2", "line", "n", F.explode(F.concat(F.array(F.lit(-1)), places)).alias("i"))
    v = v.withColumn("vk", F.when(F.col("i") < 0, F.xxhash64("line")).otherwise(F.xxhash64(_words_less("line", "n", F.col("i")))))
    v = cut(v.select("k1", "k2", "i", "vk"))
    shared = cut(v.groupBy("vk").agg(F.count("*").alias("c")).filter("c > 1").select("vk"))
    v = cut(v.join(shared, "vk", "left_semi").join(lines.select("k1", "k2", "first"), ["k1", "k2"]))
    me = F.struct("first", "k1", "k2")
    same_place = v.groupBy("vk", "i").agg(F.min(me).alias("a"), F.count("*").alias("c")).filter("c > 1 AND i >= 0").drop("c")
    whole = F.col("i") < 0
    both = (
        v.groupBy("vk")
        .agg(F.min(F.when(whole, me)).alias("itself"), F.min(F.when(~whole, me)).alias("longer"))
        .filter("itself IS NOT NULL AND longer IS NOT NULL")
    )
    found = v.join(same_place, ["vk", "i"]).select("k1", "k2", "first", F.col("a").alias("rep")).unionAll(
        v.join(both, "vk").select("k1", "k2", "first", F.when(whole, F.col("longer")).otherwise(F.col("itself")).alias("rep"))
    )
    pairs = found.filter(F.col("rep.first") < F.col("first")).select("k1", "k2", F.col("rep.k1").alias("r1"), F.col("rep.k2").alias("r2")).distinct()
    text = lines.select("k1", "k2", "line")
    other = text.select(F.col("k1").alias("r1"), F.col("k2").alias("r2"), F.col("line").alias("other"))
    checked = pairs.join(text, ["k1", "k2"]).join(other, ["r1", "r2"]).filter(within_one_word("line", "other"))
    return checked.select("k1", "k2").distinct()


def within_one_word(a: str, b: str) -> Column:
    """Whether at most one word edit separates two normal forms: their common first and last words cover the rest."""
    x, y = F.split(F.col(a), " "), F.split(F.col(b), " ")
    most = F.greatest(F.size(x), F.size(y))

    def common(p: Column, q: Column) -> Column:
        at = F.array_position(F.zip_with(p, q, lambda s, t: s.eqNullSafe(t)), F.lit(False))
        return F.when(at > 0, at - 1).otherwise(F.lit(1) * most)

    return (F.abs(F.size(x) - F.size(y)) <= 1) & (common(x, y) + common(F.reverse(x), F.reverse(y)) >= most - 1)


def _per_document(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, th (hash of the text), and the numbers of lines dropped as copies, as near ones, and all of them."""
    lines, fates = line_decisions(docs, percent)
    told = lines.join(fates, ["k1", "k2"]).filter(F.col("near") | (F.col("first") != F.col("pos")))
    return (
        told.select("pos.doc_id", "pos.th", "pos.line_no", "near")
        .groupBy("doc_id", "th")
        .agg(F.collect_set(F.when(~F.col("near"), F.col("line_no"))).alias("copies"), F.collect_set(F.when(F.col("near"), F.col("line_no"))).alias("nears"))
        .select("doc_id", "th", "copies", "nears", F.sort_array(F.concat("copies", "nears")).alias("dropped"))
    )


def line_report(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per document: its lines with words, those dropped as copies of an earlier line, those near an earlier line, and
    the numbers of the dropped lines (counted from 0 over all its lines). Documents without words have none; a null text
    is empty. Earlier means smaller doc_id (null first), then text hash, then line number."""
    per_doc = _per_document(docs, percent)
    none = F.lit(0).cast("long")
    t = text_or_empty("text")
    keys = docs.select("doc_id", F.xxhash64(t).alias("th"), F.regexp_count(t, F.lit(LINE)).cast("long").alias("n_lines"))
    same = keys["doc_id"].eqNullSafe(per_doc["doc_id"]) & (keys["th"] == per_doc["th"])
    return keys.join(per_doc, same, "left").select(
        keys["doc_id"],
        "n_lines",
        *[F.coalesce(F.size(c).cast("long"), none).alias(d) for c, d in (("copies", "n_copies"), ("nears", "n_near"))],
        F.coalesce(F.array_join("dropped", ","), F.lit("")).alias("dropped"),
    )


def drop_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the dropped lines; all rows and columns stay. Null texts stay null, rows that repeat doc_id and text
    lose the same lines."""
    gone = _per_document(docs, percent).select("doc_id", "th", "dropped")
    rows = docs.select(F.struct("*").alias("row"))
    met = rows.join(gone, F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64(text_or_empty("row.text")) == F.col("th")), "left")
    kept = F.filter(F.split("row.text", "\n", -1), lambda _, i: ~F.array_contains("dropped", i))
    text = F.when(F.col("dropped").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    return met.select(*[(text if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
