import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from chatloom.operators import packing as P

SF = "/root/testdata/sf0.01"


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [i for i, r in enumerate(rooms) if r >= n]
        if fit:
            rooms[min(fit, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    return Counter(rooms)


def test_plan_is_best_fit_decreasing():
    random.seed(1)
    for capacity in (10, 97, 500):
        for _ in range(40):
            lengths = [random.choice([random.randint(1, capacity), random.randint(1, 6)]) for _ in range(random.randint(0, 300))]
            shapes = P.plan_packs(Counter(lengths), capacity)
            got = Counter()
            for s in shapes:
                got[capacity - s.tokens] += s.count
            assert got == plain_best_fit(lengths, capacity)
            assert sum((Counter({n: c * s.count for n, c in s.items}) for s in shapes), Counter()) == Counter(lengths)
    with pytest.raises(ValueError):
        P.plan_packs({11: 1}, 10)


def test_many_rows_of_one_length_are_planned_at_once():
    shapes = P.plan_packs({4096: 10**12, 1000: 10**12 + 3, 7: 10**13}, 4096)
    assert len(shapes) < 20 and sum(s.count * c for s in shapes for n, c in s.items if n == 7) == 10**13


def check(packed, lengths, capacity, key="id"):
    rows = packed.collect()
    assert Counter(r[key] for r in rows) == Counter(lengths.keys() if isinstance(lengths, dict) else [i for i, _ in lengths])
    packs = defaultdict(list)
    for r in rows:
        fits = r.tokens is not None and 0 < r.tokens <= capacity
        assert (r.pack is not None) == fits
        if fits:
            packs[r.pack].append((r.begin, r.tokens))
    for spans in packs.values():
        at = 0
        for begin, n in sorted(spans):
            assert begin == at
            at += n
        assert at <= capacity
    assert sorted(packs) == list(range(len(packs)))
    return packs


def test_rows_get_one_place_each(spark, monkeypatch):
    random.seed(2)
    monkeypatch.setattr(P, "GROUP_ROWS", 16)  # many groups and slot rows
    lengths = [(i, random.choice([5, 5, 5, 0, None, 33, random.randint(1, 32)])) for i in range(400)]
    df = spark.createDataFrame([(i, n, "kept") for i, n in lengths], "id long, n long, extra string").repartition(5)
    packed = P.pack(df, "id", F.col("n"), 32)
    packs = check(packed, lengths, 32)
    assert len(packs) == sum(plain_best_fit([n for _, n in lengths if n and n <= 32], 32).values())
    assert packed.columns == ["id", "n", "extra", "pack", "begin", "tokens"]
    again = {r.id: (r.pack, r.begin) for r in P.pack(df.repartition(2), "id", F.col("n"), 32).collect()}
    assert again == {r.id: (r.pack, r.begin) for r in packed.collect()}
    whole = P.packed_rows(packed, F.col("id")).collect()
    assert sum(r.n for r in whole) == sum(1 for _, n in lengths if n and n <= 32) and all(len(r["items"]) == r.n and r.tokens <= 32 for r in whole)
    assert P.pack(df.limit(0), "id", F.col("n"), 32).count() == 0


def test_documents_pack_as_well_as_plain_best_fit(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.size(F.split("text", " ")).alias("n"))
    lengths = {r.doc_id: r.n for r in docs.collect()}
    packs = check(P.pack(docs, "doc_id", F.col("n"), 4096), lengths, 4096, "doc_id")
    assert len(packs) == sum(plain_best_fit([n for n in lengths.values() if n <= 4096], 4096).values())
