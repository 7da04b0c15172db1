"""Source divergence, license scans and collocations against plain Python on hand-made rows and the smallest tables."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest

from chatloom.llm import _quotient, _termcounts, collocations, license_scan, source_audit

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, term string, rank int"


def plain_divergence(rows, least=10, top=10):
    used, texts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
        used[lang or "", source or ""].update(words)
        texts[lang or ""].update(set(words))
    kept = {lang: [w for w, n in t.items() if n >= least] for lang, t in texts.items()}

    def share(count, lang, ws):
        total = sum(count[w] for w in ws)
        return {w: 1 + 10**9 * (count[w] + 2) // (total + 2 * len(ws)) for w in ws}

    p = {g: share(c, g[0], kept[g[0]]) for g, c in used.items()}
    q = {lang: share(sum((c for g, c in used.items() if g[0] == lang), Counter()), lang, ws) for lang, ws in kept.items()}
    gap = lambda x, y: (x - y) ** 2 // (x + y)
    out = set()
    for g, c in used.items():
        pairs = [(sum(gap(p[g][w], p[h][w]) for w in kept[g[0]]), h[1]) for h in used if h[0] == g[0] and h != g]
        terms = [(gap(p[g][w], q[g[0]][w]), w) for w in kept[g[0]] if c[w] and p[g][w] > q[g[0]][w]]
        order = lambda x: (-x[0], x[1].encode())
        out |= {(*g, "pair", item, v, i + 1) for i, (v, item) in enumerate(sorted(pairs, key=order))}
        out |= {(*g, "term", item, v, i + 1) for i, (v, item) in enumerate(sorted(terms, key=order)[:top])}
    return out


def told(df):
    rows = [(r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_divergence_equals_plain_python(spark):
    random.seed(3)
    words = [f"{a}{b}" for a in ("Ab", "cé", "日", "x") for b in "abcdefghij"] + ["it's", "a1b", "ÀA", "K"]
    docs = [(" ".join(random.choices(words, k=random.choice([0, 1, 5, 60]))), random.choice(["en", "de", None]), random.choice(["s", "t", "u", None])) for _ in range(150)]
    docs += [(None, "en", "empty"), ("", "none", "a"), ("once only", "none", "b"), ("lone", "solo", "x"), (" ".join(words * 3000), "en", "s")] + [("same same", "en", "t")] * 20
    rows = [(i, *d, "clash", 7) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for block_terms in (1 << 15, 7):
        assert told(source_audit.divergence(df, block_terms=block_terms)) == plain_divergence(docs)
    assert told(source_audit.divergence(df, least_texts=2, top_terms=3)) == plain_divergence(docs, 2, 3)
    assert source_audit.divergence(df.limit(0)).count() == 0


def test_galloping_and_prices():
    rng = np.random.default_rng(1)
    for n, m in ((1, 1), (5, 1000), (300, 700), (64, 64), (3, 0), (200, 129)):
        long = np.unique(rng.integers(0, 2000, m))
        short = np.unique(rng.integers(0, 2100, n))
        if len(long):
            assert (source_audit.gallop(short, long) == np.searchsorted(long, short)).all()
    big = np.array([0, 1, 9 * 10**9, 7 * 10**12])
    total = int(big.sum()) + 8
    assert source_audit.prices(big, total).tolist() == [1 + 10**9 * (int(c) + 2) // total for c in big]


def plain_collocations(docs, least=100, most=5, top=2000):
    found, total = defaultdict(Counter), Counter()
    for text, lang in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            found[lang or "und"].update(tuple(w[i : i + m]) for m in range(1, most + 1) for i in range(len(w) - m + 1))
    out = set()
    for lang, f in found.items():
        often = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        inside = defaultdict(int)
        for p, a in often.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], a)
        n = total[lang]
        rows = []
        for p, a in often.items():
            if inside[p] < a:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out |= {(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])}
    return out


def test_collocations_equal_plain_python(spark):
    random.seed(5)
    words = ["New", "york", "é", "日本", "a", "b", "c-d", "it's", "x"]
    docs = [("".join(random.choice(words) + random.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n"]) for _ in range(random.choice([0, 1, 4, 50]))), random.choice(["en", "de", None])) for _ in range(120)]
    docs += [("a b New york x", "en")] * 40 + [(None, "fr"), (" . ;\n", "fr"), ("a b c d e f g", "es"), ("b a " * 20_000, "long")]
    df = spark.createDataFrame([(i, *d, "clash", 7) for i, d in enumerate(docs)], "doc_id long, text string, lang string, term string, n int").repartition(3)
    fields = "lang rank phrase a l r n score".split()
    for least, most_ids, top in ((5, 1 << 22, 2000), (3, 8, 2000), (100, 3, 2)):
        rows = [tuple(r[f] for f in fields) for r in collocations.collocations(df, least, top=top, most_ids=most_ids).collect()]
        assert len(rows) == len(set(rows)) and set(rows) == plain_collocations(docs, least, top=top)
    assert collocations.collocations(df.limit(0)).count() == 0 and collocations.collocations(df, 10**6).count() == 0


def test_word_counting_takes_little_memory(spark, monkeypatch):
    """The bytes of many terms are picked with a few bytes beside each (before: 24), op13's Python tasks get small batches, and
    their words come out the same when few are held."""
    n = 1 << 18
    start = np.random.default_rng(3).permutation(n) * 8
    terms = _termcounts._Terms(*[np.zeros(n, np.int64)] * 4, np.arange(8 * n, dtype=np.uint32).astype(np.uint8), start, np.full(n, 8))
    tracemalloc.start()
    data, at = terms.bytes_of()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (data.reshape(-1, 8) == terms.data.reshape(-1, 8)[start // 8]).all() and at[-1] == 8 * n and peak < 8 * len(data)
    name, seen, found = "spark.sql.execution.arrow.maxBytesPerBatch", [], collocations.frequent_phrases
    before = spark.conf.get(name)
    monkeypatch.setattr(collocations, "frequent_phrases", lambda *a: seen.append(spark.conf.get(name)) or found(*a))
    monkeypatch.setattr(collocations, "HELD_WORDS", 4)
    docs = [(" ".join(f"w{i % 7}" for i in range(k, k + 9)), "en") for k in range(60)]
    got = collocations.collocations(spark.createDataFrame(docs, "text string, lang string"), 5).collect()
    assert {tuple(r[f] for f in "lang rank phrase a l r n score".split()) for r in got} == plain_collocations(docs, 5)
    assert seen == [str(8 << 20)] and spark.conf.get(name) == before


def test_counting_filters_are_lossless():
    rng = np.random.default_rng(2)
    for bits in (1, 8, 13):
        keys = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
        keys[:40] = np.arange(40)
        keys = np.concatenate([keys, keys[:300], np.repeat(keys[7], 70_000)])
        counter = _quotient.ShardedCounter(bits, held=2000)
        filters = [f for part in np.array_split(keys, 50) for f in counter.add(part)] + list(counter.rest())
        shards = defaultdict(list)
        for shard, raw in filters:
            shards[shard].append(_quotient.unpack(raw, shard, bits))
        got = Counter()
        for parts in shards.values():
            k, n = _quotient.merged(iter(parts), held=500)
            assert (np.diff(k.astype(object)) > 0).all()
            got.update(dict(zip(_quotient.unmix(k).tolist(), n.tolist(), strict=True)))
        assert got == Counter(keys.tolist())


def test_counting_takes_little_memory():
    """A task's counter holds few keys at once (before: 170 MB for 2 million keys, now 57 MB)."""
    rng = np.random.default_rng(4)
    parts, sizes = [rng.integers(0, 1 << 63, 1 << 16, dtype=np.uint64) for _ in range(32)], 0
    _quotient.mix(parts[0])
    tracemalloc.start()
    counter = _quotient.ShardedCounter(8)
    for part in parts:
        for _, raw in counter.add(part):
            sizes += int(np.frombuffer(raw, "<i8", 1)[0])
    sizes += sum(int(np.frombuffer(raw, "<i8", 1)[0]) for _, raw in counter.rest())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sizes == 1 << 21 and peak < 64e6


def test_license_phrases_equal_plain_python(spark):
    random.seed(9)
    parts = ["GNU General Public License", "cc by", "CC-BY-NC", "MIT\nLicense", "apache License,", "the", "gnu general", "ccé by", "K by", "mit", "license", "by"]
    texts = [random.choice([" ", "--", "\x00"]).join(random.choices(parts, k=random.choice([0, 1, 2, 30]))) for _ in range(80)] + [None, "", "...", "cc by " * 30_000]
    docs = [(i // 2, t, "clash", 1, "w") for i, t in enumerate(texts)] + [(None, "MIT license", "clash", 1, "w")]
    df = spark.createDataFrame(docs, "doc_id long, text string, template string, row int, words string").repartition(3)
    want = Counter()
    for d, t, *_ in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = [(i, name) for name, p in license_scan.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        places = [i for i, _ in at]
        want[d, len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({n for _, n in at}))] += 1
    got = license_scan.license_report(df).collect()
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
    assert all(r.score == 1 for r in got if r.n_base) and all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)
    assert license_scan.license_report(df.limit(0)).count() == 0


def test_license_notices_with_edits_and_two_in_one_text(spark):
    notice = {name: text.split() for name, text, base in license_scan.default_templates() if name in ("isc", "bsd", "unlicense", "mpl-2.0")}
    changed = notice["isc"][:12] + ["put", "in"] + notice["isc"][12:20] + notice["isc"][21:]
    texts = [" ".join(["so"] * 40 + changed + ["end"] * 5), " ".join(notice["bsd"] + ["x"] * 9 + notice["unlicense"]), " ".join(notice["mpl-2.0"][:12]), "Licensed under CC BY-NC 4.0.", " ".join(notice["bsd"][::-1])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.license_report(df).collect()}
    assert [got[i].labels for i in range(5)] == ["isc", "bsd,unlicense", "", "cc-by,cc-by-nc", ""]
    assert 0.8 < got[0].score < 1 and got[1].score == 1 and 0 < got[2].score < 0.6 and got[4].score == 0
    span = [r for r in license_scan.license_spans(df).collect() if r.doc_id == 0 and r.label == "isc"]
    assert len(span) == 1 and 37 <= span[0].first_word <= 43
