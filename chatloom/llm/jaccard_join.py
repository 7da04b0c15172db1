"""N-gram Jaccard join of documents by a grouped prefix join.

A document's set holds its distinct word shingles. In an order with rare shingles first, two sets with Jaccard >= t
share one of their first n - ceil(t*n) + 1 shingles. Documents with equal sets are one unit, units with equal prefix and
size one group; groups meet on prefix shingles, pairs of groups are filtered by size and by how much of their prefixes
they share, and the pairs that remain are expanded to units and verified on whole sets.

What is wanted are components. So links are looked for in rounds. In the first ones, each group is compared with one pivot
of those it shares shingles with, which is linear in the number of shingles and joins nearly all copies; groups at shingles
that many components still share try further ones. Then only pairs of groups from different components are looked at,
completely: no link between components is lost, and large groups of near copies are not paired up with themselves.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import cut, drop, small_batches
from ._components import components
from ._wordhash import shingle_sets, shingles

WORDS = 5
#: Shingles are counted in 2**bits counters, about one for PER_COUNTER shingles within these bounds. Counts only order
#: shingles; any order gives the same links. Broadcast as one byte a counter (their logarithms): 16 MB at most.
LEAST_BITS, MOST_BITS, PER_COUNTER = 16, 24, 128
BLOCKS = 64
STEPS = 8  # of a count's logarithm, per doubling
#: A shingle's postings are split over several lists so that a list has about HOT entries, or 8 times what an average counter
#: shows where that is more.
HOT = 1_000
PIVOT_ROUNDS = 2
#: A shingle is crowded if more than CROWD of its postings are outside its most common component. Where crowded shingles make
#: up to FEW_PAIRS pairs of postings for each posting there is, or a pivot brings few links, the last step takes over. That
#: step is complete, so this changes the time only.
CROWD = 16
FEW_PAIRS = 1
#: So many shingles before its own a posting carries to the last step, to be met there once a pair, mostly.
BEFORE = 3
#: Ids up to this number (16 MB) are broadcast to the scan of what belongs to them; more are joined by shuffle.
MOST_BROADCAST = 1_000_000


def _count_shingles(k: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for s in shingles(batch.column(0), k):
                np.add.at(counts, s >> np.uint64(64 - bits), 1)
        parts = counts.reshape(BLOCKS, -1)
        yield pa.record_batch([pa.array(range(BLOCKS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["block", "counts"])

    return run


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum what arrives, block by block, and keep logarithms; memory is that of the blocks, however many tasks sent counts."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            part = np.frombuffer(raw.as_buffer(), np.uint32)
            sums[block] = sums[block] + part if block in sums else part.astype(np.uint64)
    for block, s in sums.items():
        levels = np.minimum(np.ceil(STEPS * np.log2(np.maximum(s, 1))), 255).astype(np.uint8)
        yield pa.record_batch([pa.array([block], pa.int32()), pa.array([levels.tobytes()], pa.binary())], ["block", "levels"])


def shingle_levels(docs: DataFrame, k: int) -> tuple[np.ndarray, float]:
    """STEPS times the logarithm of how often each counter's shingles occur, rounded up; the average of the counters."""
    # About a word for every six bytes. It only sizes the counters.
    words = (docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0) / 6
    bits = min(MOST_BITS, max(LEAST_BITS, round(math.log2(words / PER_COUNTER + 1))))
    # Each task sends its counters, so it should see some words for each of them.
    texts = docs.select("text").coalesce(max(1, round(words / (4 << bits))))
    parts = texts.mapInArrow(_count_shingles(k, bits), "block int, counts binary")
    rows = parts.repartition("block").mapInArrow(_add_counts, "block int, levels binary").collect()
    total = np.zeros((BLOCKS, (1 << bits) // BLOCKS), np.uint8)
    for r in rows:
        total[r["block"]] = np.frombuffer(r["levels"], np.uint8)
    return total.reshape(-1), words / (1 << bits)


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _prefixes(shared, k: int, percent: int, hot: float):
    """doc_id, text to doc_id, n, digest of the set, digest of the prefix, the prefix in order, and for its last shingles,
    the hot ones, over how many lists their postings go."""
    bar = STEPS * math.log2(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = shared.value
        bits = len(levels).bit_length() - 1
        lists = np.ceil(2.0 ** (np.arange(256) / STEPS) / hot).astype(np.int32)
        for batch in batches:
            n, whole, first, prefix, parts = [], [], [], [], []
            for s in shingle_sets(batch.column(1), k):
                often = levels[s >> np.uint64(64 - bits)]
                order = np.argsort(often, kind="stable")  # s is sorted, so ties are in the order of the hashes
                p = _prefix_length(len(s), percent) if len(s) else 0
                head, often = s[order[:p]], often[order[:p]]
                n.append(len(s))
                whole.append(_digest(s))
                first.append(_digest(head))
                prefix.append(head.view(np.int64))
                parts.append(lists[often[often > bar]])
            yield pa.record_batch(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(whole, pa.binary()), pa.array(first, pa.binary()), _list_array(prefix, np.int64), _list_array(parts, np.int32)],
                ["doc_id", "n", "whole", "first", "prefix", "parts"],
            )

    return run


def _prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _list_array(values: list[np.ndarray], kind: type) -> pa.ListArray:
    lengths = np.cumsum([0] + [len(v) for v in values])
    return pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.concatenate([*values, np.empty(0, kind)])))


def _sets(k: int):
    """id, digest of the wanted set, text to id and set; a text with another set (of a repeated doc_id) gives no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, whole = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            kept = [(i, s.tobytes()) for i, w, s in zip(ids, whole, shingle_sets(batch.column(2), k), strict=True) if _digest(s) == w]
            yield pa.record_batch([pa.array([i for i, _ in kept], pa.int64()), pa.array([s for _, s in kept], pa.binary())], ["id", "shingles"])

    return run


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                s = np.concatenate([x, y])
                s.sort()
                both = int((s[1:] == s[:-1]).sum())
                keep.append(both > 0 and 100 * both >= percent * (len(s) - both))
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _small(ids: DataFrame) -> DataFrame:
    """``ids``, a table cut before, to be broadcast if it has at most MOST_BROADCAST rows."""
    return F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids


def verify(docs: DataFrame, units: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of units whose whole sets are similar. One scan turns the documents in pairs into sets; the
    set of a goes to that of b, and skewed units are split by adaptive execution. ``units`` has unit, doc_id, whole."""
    pairs = cut(pairs.distinct())
    ids = pairs.select(F.explode(F.array("a", "b")).alias("unit")).distinct()
    ids = cut(units.select("unit", F.col("doc_id").alias("_d"), "whole").join(ids, "unit", "left_semi"))
    texts = docs.join(_small(ids), docs["doc_id"] == ids["_d"]).select("unit", "whole", "text")
    sets = cut(texts.mapInArrow(_sets(k), "id long, shingles binary"))
    if sets.count() > ids.count():  # rows that repeat doc_id and text
        repeated, sets = sets, cut(sets.dropDuplicates(["id"]))
        drop(repeated)
    left = pairs.join(sets.select(F.col("id").alias("a"), "shingles"), "a")
    met = left.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("other")), "b").select("a", "b", "shingles", "other")
    found = cut(met.mapInArrow(_similar(percent), "a long, b long"))
    drop(pairs, ids, sets)
    return found


def _prefix(n: Column, percent: int) -> Column:
    """As _prefix_length, in whole numbers."""
    return n - F.floor((n * percent + 99) / 100) + 1


def _overlap(n: Column, m: Column, percent: int) -> Column:
    """How many shingles similar sets of sizes n and m share at least."""
    return F.floor(((n + m) * percent + (99 + percent)) / (100 + percent))


def _needed(n: Column, m: Column, percent: int) -> Column:
    """How many shingles the prefixes of similar sets of sizes n and m share at least: the least overlap of the sets, less
    what can stand behind the prefixes."""
    overlap = _overlap(n, m, percent)
    return F.greatest(overlap - F.greatest(n - _prefix(n, percent), m - _prefix(m, percent)), F.lit(1))


def jaccard_components(docs: DataFrame, k: int = WORDS, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(members, comps): doc_id, n, unit and the unit's ``least`` doc_id of every row of ``docs``; unit and component_id of
    the units that are linked with others. A row without a unit (no words, or a null doc_id) is linked with nothing.

    Ids must be long (others are cast). Rows that repeat a doc_id are one document, linked if any of their texts is."""
    with small_batches(docs.sparkSession):
        return _linked(docs, k, percent)


def _linked(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    sc = docs.sparkSession.sparkContext
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted, average = shingle_levels(docs, k)
    levels = sc.broadcast(counted)
    schema = "doc_id long, n long, whole binary, first binary, prefix array<long>, parts array<int>"
    made = docs.mapInArrow(_prefixes(levels, k, percent, max(HOT, 8 * average)), schema)
    made = cut(made.withColumn("row", F.monotonically_increasing_id()))
    levels.destroy()
    some = made.filter("n > 0 AND doc_id IS NOT NULL")

    # Units: equal sets, named by one of their rows. Groups: equal prefix and size, named by their smallest unit.
    units = some.groupBy("whole").agg(F.min(F.struct("row", "doc_id", "n", "first")).alias("head"), F.min("doc_id").alias("least"))
    units = cut(units.select(F.col("head.row").alias("unit"), "whole", "head.doc_id", "head.n", "head.first", "least"))
    members = made.select("row", "doc_id", "n", "whole").join(units.select("whole", "unit", "least"), "whole", "left")
    members = cut(members.select("row", "doc_id", "n", *[F.when(F.col("doc_id").isNotNull(), F.col(c)).alias(c) for c in ("unit", "least")]))
    of_group = units.groupBy("n", "first").agg(F.min("unit").alias("gid"), F.count("*").alias("units"))
    grouped = cut(units.select("unit", "n", "first").join(of_group, ["n", "first"]).select("unit", "gid", "n", "units"))
    others = members.filter("row <> unit").select("row").unionAll(grouped.filter("unit <> gid").select("unit"))
    others = cut(others)
    groups = made.filter("doc_id IS NOT NULL").join(_small(others), "row", "left_anti").select(F.col("row").alias("gid"), "n", "prefix", "parts")

    # Postings: a group at each shingle of its prefix; those that no other group has drop out here.
    at_part = F.col("pos") - F.size("prefix") + F.size("parts")
    list_of = F.when(at_part >= 0, F.pmod(F.xxhash64("gid"), F.get("parts", at_part))).otherwise(F.lit(-1).cast("long"))
    posts = groups.select("gid", "n", "prefix", "parts", F.posexplode("prefix").alias("pos", "token")).select("token", list_of.alias("list"), "gid", "n", "pos")
    at = Window.partitionBy("token", "list")
    posts = posts.withColumns({"c": F.count("*").over(at), "pivot": F.min("gid").over(at)}).filter("c > 1 OR list >= 0")
    posts = cut(posts.select("token", "list", "gid", "n", "pos", "pivot"))
    drop(made, others)

    # A doc_id with several texts links them.
    several = members.filter("unit IS NOT NULL").groupBy("doc_id").agg(F.min("unit").alias("b"), F.max("unit").alias("most")).filter("b < most")
    links = members.join(several.select("doc_id", "b"), "doc_id").select(F.col("unit").alias("a"), "b").filter("a <> b")
    sizes = grouped.filter("unit = gid").select(F.col("gid").alias("pivot"), F.col("n").alias("m"))

    def best(tried: DataFrame) -> DataFrame:
        """(a, b): units of a group against the head of one of its pivots, the one it shares most shingles with of those
        it shares enough with."""
        c = tried.filter("gid <> pivot").groupBy("gid", "pivot").agg(F.count("*").alias("c"), F.first("n").alias("n"))
        c = c.join(sizes, "pivot").filter(_close("n", "m", percent) & (F.col("c") >= _needed(F.col("n"), F.col("m"), percent)))
        chosen = c.groupBy("gid").agg(F.max(F.struct("c", F.col("pivot"))).alias("x")).select("gid", F.col("x.pivot").alias("b"))
        return chosen.join(grouped.select("gid", "unit"), "gid").select(F.col("unit").alias("a"), "b")

    over_lists = posts.filter("list >= 0").groupBy("token", "pivot").agg(F.first("list"))
    over_lists = over_lists.withColumn("least", F.min("pivot").over(Window.partitionBy("token"))).select(F.col("pivot").alias("a"), F.col("least").alias("b"))
    start = best(posts).unionAll(over_lists.filter("a <> b"))
    start = start.unionAll(grouped.filter("unit <> gid").select(F.col("unit").alias("a"), F.col("gid").alias("b")))
    comps = components(verify(docs, units, start, k, percent).unionAll(links))

    def state(posts: DataFrame) -> tuple[DataFrame, DataFrame, bool, tuple]:
        """Components of units so far, the postings at shingles that still see two (low and high differ if a group's units
        do), whether crowded ones make so few pairs that another pivot would save nothing, and the tables behind that."""
        of_unit = grouped.join(comps.withColumnRenamed("id", "unit"), "unit", "left").withColumn("comp", F.coalesce("comp", "unit"))
        of_unit = cut(of_unit)
        ranges = of_unit.groupBy("gid").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
        seen = posts.select("token", "gid", "n", "pos").join(ranges, "gid")
        tally = seen.groupBy("token").agg(F.min("low").alias("x"), F.max("high").alias("y"), F.count("*").alias("c")).filter("x < y AND c > 1")
        seen = cut(seen.join(tally.select("token"), "token", "left_semi"))
        of_comp = seen.groupBy("token", F.when(F.col("low") == F.col("high"), F.col("low")).alias("low"))
        of_comp = of_comp.agg(F.count("*").alias("count"), F.min("n").alias("least"), F.max("n").alias("most"))
        sizes_of = (F.min("least").alias("least"), F.max("most").alias("most"))
        majors = of_comp.groupBy("token").agg(F.sum("count").alias("c"), *sizes_of, F.max(F.when(F.col("low").isNotNull(), F.struct("count", "low"))).alias("m"))
        minors = F.col("c") - F.coalesce("m.count", F.lit(0))
        majors = cut(majors.select("token", F.col("m.low").alias("major"), "least", "most", "c", minors.alias("minors")))
        pairs = F.when(F.col("minors") > CROWD, F.col("c").cast("double") * F.col("minors"))
        total = majors.agg(F.sum("c").alias("posts"), F.sum(pairs).alias("pairs")).first()
        wide = seen.join(majors.select("token", "major", "least", "most", "minors"), "token")
        return of_unit, wide, (total["pairs"] or 0) <= FEW_PAIRS * (total["posts"] or 0), (seen, majors)

    of_unit, open_posts, few, tables = state(posts)
    for r in range(1, PIVOT_ROUNDS):
        if few:
            break
        # Another pivot for each shingle of the groups at crowded ones: first the group with most open shingles, as the one with
        # fewest edits is nearest to all others; in later rounds by a hash that changes.
        crowd = open_posts.filter(F.col("minors") > CROWD).select("gid").distinct()
        crowd = cut(open_posts.join(crowd, "gid", "left_semi"))
        ranked = crowd.join(crowd.groupBy("gid").agg(F.count("*").alias("much")), "gid")
        rank = F.struct((-F.col("much") if r == 1 else F.xxhash64("gid", F.lit(r))).alias("h"), F.col("gid").alias("pivot"), F.col("low").alias("pl"))
        pivots = ranked.groupBy("token").agg(F.min(rank).alias("p"))
        tried = crowd.join(pivots, "token").filter("low <> p.pl").select("gid", "n", F.col("p.pivot").alias("pivot"))
        tried = cut(best(tried))
        found = verify(docs, units, tried, k, percent)
        comps, before = _joined(comps, of_unit, found), (of_unit, *tables)
        of_unit, open_posts, few, tables = state(before[1])  # shingles that see one component do so from then on
        few |= found.count() * 10 < tried.count()
        drop(crowd, tried, found, *before)
    found = verify(docs, units, _remaining_pairs(open_posts, of_unit, percent), k, percent)
    comps = _joined(comps, of_unit, found)
    drop(posts, of_unit, *tables)

    # A component's name is its smallest doc_id.
    of_comp = comps.withColumnRenamed("id", "unit").join(units.select("unit", "least"), "unit")
    names = of_comp.groupBy("comp").agg(F.min("least").alias("component_id"))
    return members, cut(comps.join(names, "comp").select(F.col("id").alias("unit"), "component_id"))


def _joined(comps: DataFrame, of_unit: DataFrame, links: DataFrame) -> DataFrame:
    """Components (id, comp) of units after more links between them: only the components that these join are looked at."""
    comp = of_unit.select("unit", "comp")
    between = links.join(comp.toDF("a", "ca"), "a").join(comp.toDF("b", "cb"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    moved = components(between).toDF("comp", "now")
    new = comp.join(moved, "comp").select(F.col("unit").alias("id"), F.col("now").alias("comp"))
    return cut(comps.join(new, "id", "left_anti").unionAll(new))


def _close(n: str, m: str, percent: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _meetings(full: DataFrame, percent: int) -> DataFrame:
    """(g, h, n_x, n_y): groups of different components, once for each shingle that can be the first one they share.

    Behind the first shared shingle, in both sets, stands all else that they share, so it lies before the last places of an
    overlap as large as their two sizes call for. What many unlinked texts share stands late in their order, behind what is
    their own, and makes no rows. Nor does a shingle that both have another one of right before, among the last BEFORE: it is
    not the first, and the first has none. Postings meet by shingle and range of sizes. Each shingle's most common component stands
    on one side, the others on both, so that a large component is paired with what is outside it, never with itself."""
    band = F.floor(F.log("n") / math.log(100 / percent)).cast("int")
    in_order = Window.partitionBy("sid").orderBy("pos")
    full = full.withColumn("before", F.array_compact(F.array(*[F.lag("token", i).over(in_order) for i in range(1, BEFORE + 1)])))
    full = full.withColumns({"minor": (F.col("low") != F.col("high")) | F.coalesce(F.col("low") != F.col("major"), F.lit(True)), "band": band}).drop("major")
    x = full.filter("minor").select(*[F.col(c).alias(f"{c}_x") for c in ("token", "sid", "low", "high", "n", "pos", "before")], F.explode(F.array(*[F.col("band") + d for d in (-1, 0, 1)])).alias("band_x"))
    y = full.select(*[F.col(c).alias(f"{c}_y") for c in full.columns])
    overlap = _overlap(F.col("n_x"), F.col("n_y"), percent)
    meet = (
        (F.col("token_x") == F.col("token_y"))
        & (F.col("band_x") == F.col("band_y"))
        & (~F.col("minor_y") | (F.col("sid_x") < F.col("sid_y")))
        & ((F.col("low_x") != F.col("low_y")) | (F.col("low_x") != F.col("high_x")) | (F.col("low_y") != F.col("high_y")))
        & _close("n_x", "n_y", percent)
        & (F.col("pos_x") <= F.col("n_x") - overlap)
        & (F.col("pos_y") <= F.col("n_y") - overlap)
        & ~F.arrays_overlap("before_x", "before_y")
    )
    return x.join(y, meet).select(F.least("sid_x", "sid_y").alias("g"), F.greatest("sid_x", "sid_y").alias("h"), "n_x", "n_y")


def _remaining_pairs(open_posts: DataFrame, of_unit: DataFrame, percent: int) -> DataFrame:
    """All pairs of units (a, b) of different components that the size and overlap filters let pass.

    Similar sets share enough shingles within their prefixes, and all those are among the open postings, so they are
    counted there. A group with fewer of them than the sizes around it call for has no such pair; groups of one size and
    component with the same open shingles meet others as one, each shingle at its first place in any of them."""
    mixed = F.col("low") != F.col("high")
    of_group = open_posts.groupBy("gid", "n", "low", "high").agg(
        F.count("*").alias("c"), F.min("least").alias("least"), F.max("most").alias("most"), F.sort_array(F.collect_list("token")).alias("tokens")
    )
    n = F.col("n")
    smallest = F.greatest("least", F.ceil(n * percent / 100))
    most = F.least("most", F.floor(n * 100 / percent))
    # What is needed falls on both sides of n, so the ends of the range call for least, rounding aside.
    enough = F.least(_needed(n, smallest, percent), _needed(n, most, percent)) - 1
    alike = ["h1", "h2", "n", "low", "own"]
    hashes = [F.xxhash64("tokens").alias("h1"), F.xxhash64(F.lit(1), "tokens").alias("h2")]
    of_group = cut(of_group.filter(F.col("c") >= enough).select("gid", "n", "low", *hashes, F.when(mixed, F.col("gid")).otherwise(-1).alias("own"), "tokens"))
    members = cut(of_group.join(of_group.groupBy(*alike).agg(F.min("gid").alias("sid")), alike).select("sid", "gid"))
    # Places too late for the smallest set that a shingle has to offer are too late for all.
    early = open_posts.filter(F.col("pos") <= n - _overlap(n, smallest, percent)).join(members, "gid")
    early = early.groupBy("token", "sid").agg(F.min("pos").alias("pos"), *[F.first(c).alias(c) for c in ("n", "low", "high", "major")])
    pairs = _meetings(early, percent).groupBy("g", "h").agg(F.first(_needed(F.col("n_x"), F.col("n_y"), percent)).alias("need"))
    tokens = of_group.select(F.col("gid").alias("g"), "tokens")
    pairs = pairs.join(tokens, "g").join(tokens.toDF("h", "others"), "h").filter(F.size(F.array_intersect("tokens", "others")) >= F.col("need")).select("g", "h")
    u = of_unit.join(members, "gid").select("sid", "unit", "comp")
    a, b = u.toDF("g", "a", "ca"), u.toDF("h", "b", "cb")
    across = pairs.join(a, "g").join(b, "h").filter("ca <> cb").select("a", "b")
    # Within a group whose units fell into several components.
    split = of_unit.filter("units > 1")
    main = split.groupBy("gid", "comp").count().groupBy("gid").agg(F.max(F.struct("count", "comp")).alias("m")).select("gid", F.col("m.comp").alias("main"))
    split = split.join(main, "gid").select("gid", "unit", "comp", "main")
    c, d = split.filter("comp <> main").select("gid", F.col("unit").alias("a"), F.col("comp").alias("ca")), split.select("gid", F.col("unit").alias("b"), F.col("comp").alias("cb"))
    return across.unionAll(c.join(d, "gid").filter("ca <> cb").select("a", "b"))


def component_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (null for a null doc_id). Null and empty texts have no
    shingles and are linked with nothing; other columns are ignored."""
    members, comps = jaccard_components(docs)
    return members.join(comps, "unit", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "least", "doc_id").alias("component_id"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each component stays: that with the smallest doc_id (all its rows, if it is repeated). Equal sets
    are a component too. Rows with a null doc_id and documents without words stay; so do all columns."""
    members, comps = jaccard_components(docs)
    gone = members.join(comps, "unit", "left").filter(F.col("doc_id") != F.coalesce("component_id", "least")).select(F.col("doc_id").alias("id"))
    rows = docs.select(F.struct("*").alias("row"))
    return rows.join(gone, F.col("row.doc_id").cast("long") == F.col("id"), "left_anti").select("row.*")
