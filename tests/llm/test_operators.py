"""Each training-data operator against a brute-force version, on hand-made rows and on the smallest tables."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from pyspark.sql import functions as F

from chatloom.llm import chat_format, decontaminate, exact_dedup, html_text, jaccard_join, line_dedup, mixing, secrets, sharding, toxicity
from chatloom.llm.queries import ORACLE, QUERIES
from oracle import rows as result_rows
from oracle import twin

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i}" for i in range(3000))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int"
ODD = [
    (1, "a b c d e f", "en", "s", 1, 9), (2, "a b\tc d e f", "en", None, 1, 9), (3, None, None, None, None, None), (4, "", "en", "s", 0, 9),
    (5, LONG, "en", "t", 1, 9), (6, LONG + " more", "en", "t", 1, 9), (6, LONG + " more", "en", "t", 1, 9), (None, "lone", "en", "t", 1, 9), (7, " \n ", "en", "", 1, 9),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_all_operators_take_empty_tables(spark, odd):
    none = odd.limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    for f in (secrets.secret_report, line_dedup.line_report, mixing.mix_report, sharding.shard_report, jaccard_join.component_report, exact_dedup.radix_groups):
        assert f(none).count() == 0
    assert toxicity.toxicity_report(none, labels).count() == 0
    assert decontaminate.contamination_report(none, bench).count() == 0
    assert decontaminate.contamination_report(odd, bench).filter("contaminated").count() == 0
    assert {r.score for r in toxicity.toxicity_report(odd, labels).collect()} == {0.0}


def test_secrets(spark, docs):
    extra = spark.createDataFrame([(-1, 'é token = "ab.cd-EF12" password:x1 AKIA' + "Z" * 16 + " " + "0af" * 9, "en", "s", 1), (-2, None, "en", "s", 1)], docs.schema)
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    d = docs.unionAll(extra)
    got = {r.doc_id: r for r in secrets.secret_report(d).collect()}
    for r in d.collect():
        t = r.text or ""
        s = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        s += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        s += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        said = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(s))
        assert got[r.doc_id].base_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert (got[-1].n_assign, got[-1].n_access, got[-1].n_hex) == (1, 1, 1)


def test_entropy_spans_and_allow_list(spark):
    t = "key AbC9dEf2GhI5jKl8MnO1pQr4StU7 id 123e4567-e89b-12d3-a456-426614174000 path some/path-name-here-2020"
    d = spark.createDataFrame([(1, t)], "doc_id long, text string")
    assert secrets.secret_report(d).first().spans == "entropy:4:32"
    assert secrets.redact_secrets(d).first().text == t.replace("AbC9dEf2GhI5jKl8MnO1pQr4StU7", "[SECRET]")


def test_entropy_windows_equal_plain_python(spark):
    random.seed(7)
    kinds = [secrets.ALPHABET, "0123456789abcdef", "ABCDEF0123456789", "ab1", "a1" + secrets.ALPHABET[:12]]
    texts = ["".join(random.choice(k) for _ in range(random.randint(1, 90))) for k in kinds for _ in range(50)]
    w, want = secrets.WINDOW, {}
    for i, t in enumerate(texts):
        first = last = 0
        for end in range(w, len(t) + 1):
            part = t[end - w : end]
            bits = -sum(part.count(c) / w * math.log2(part.count(c) / w) for c in set(part))
            digits = sum(c.isdigit() for c in part)
            one_case = digits + sum(c in "abcdef" for c in part) == w or digits + sum(c in "ABCDEF" for c in part) == w
            if bits >= (secrets.HEX_BITS if one_case and 0 < digits < w else secrets.MIXED_BITS) - 1e-7:
                first, last = first or end - w + 1, end
        want[i] = (first, last)
    d = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert {r.i: tuple(r.hot) for r in d.select("i", secrets._hot_part(F.col("t"), w).alias("hot")).collect()} == want
    assert any(a for a, _ in want.values())


def test_long_strings_take_time_in_proportion(spark):
    random.seed(8)
    long = "".join(random.choice(secrets.ALPHABET) for _ in range(300_000))
    texts = [long, "password=abcdef12 " * 10_000, "ab-1/" * 50_000, "a1" + "bcd" * 100_000, "x" * 300_000]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    began = time.time()
    got = {r.doc_id: r for r in secrets.secret_report(d).collect()}
    assert time.time() - began < 60
    assert got[0].spans and got[1].n_assign == 10_000 and not got[2].spans and not got[4].spans


def test_entropy_by_window_beside_base_spans_and_allowed_parts(spark):
    key, digest = "wJ4lrXUtnFEM1bK7MDENGqbPxRfiCYzK3yVtQ8sH", "9f86d081884c7d659a2feaa0c55ad015"
    cases = {
        f"KEY={digest.upper()}": digest.upper(), f"id={digest[:20]}": digest[:20], f"AKIA{'Q7' * 8}/{key}": key, f"{digest}_{key}": key,
        f"{key}_{digest}": key, f"sample_key={key}": key, f"{key}/example": key,
    }
    clean = ["order-12345678901234567890", "a0123456789012345678901", "example_placeholder/some-path-name-here-2020", f"{digest}/some-path-name-here-2020"]
    texts = [*cases, *clean]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secrets.secret_report(d).collect()}
    said = {r.doc_id: r.text for r in secrets.redact_secrets(d).collect()}
    for i, t in enumerate(texts):
        spans = [x.split(":")[1:] for x in got[i].split(",") if x.startswith("entropy")]
        if t in cases:
            at = t.index(cases[t])
            assert any(int(a) <= at and int(b) >= at + len(cases[t]) for a, b in spans), (t, got[i])
            assert cases[t] not in said[i]
        else:
            assert not spans, (t, got[i])


@pytest.fixture(params=["10m", "-1"])
def broadcast_up_to(spark, request):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield request.param
    spark.conf.set(name, before)


def test_line_dedup_equals_brute_force(spark, broadcast_up_to):
    random.seed(1)
    lines = [" ".join(random.choice("abc") for _ in range(random.choice([1, 4, 5, 6, 7]))) for _ in range(150)]
    texts = [(i, "\n".join(random.choice(lines) for _ in range(5))) for i in range(60)] + [(60, None), (61, "")]
    got = {r.doc_id: r for r in line_dedup.line_report(spark.createDataFrame(texts, "doc_id long, text string")).collect()}

    def near(a, b):
        p, q = sorted((a, b), key=len)
        if len(q) - len(p) > 1 or p == q or 100 * (len(q) - 1) < line_dedup.PERCENT * len(q):
            return False
        return any(q[:i] + q[i + 1 :] == (p if len(p) < len(q) else p[:i] + p[i + 1 :]) for i in range(len(q)))

    first = {}
    for i, t in texts:
        for k, line in enumerate((t or "").split("\n")):
            if line:
                key = tuple(line.split())
                pos = (i, k)
                first[key] = min(first.get(key, pos), pos)
    dead = {a for a in first if any(first[b] < first[a] and near(a, b) for b in first)}
    for i, t in texts:
        said = (t or "").split("\n")
        near_at = [k for k, line in enumerate(said) if tuple(line.split()) in dead]
        gone = [k for k, line in enumerate(said) if line and (k in near_at or first[tuple(line.split())] != (i, k))]
        assert got[i].dropped == ",".join(map(str, gone)), i
        assert (got[i].n_lines, got[i].n_copies, got[i].n_near) == (sum(map(bool, said)), len(gone) - len(near_at), len(near_at))


def test_line_normal_form(spark):
    t = "\t\tA  b\r\n \t\n\x0b\nc \td\x0c e\n"
    got = [(r.pos.line_no, r.line, r.n) for r in line_dedup.text_lines(spark.createDataFrame([(1, t)], "doc_id long, text string")).collect()]
    assert sorted(got) == [(0, "a b", 2), (3, "c d e", 3)]
    r = line_dedup.line_report(spark.createDataFrame([(1, t), (1, t), (None, "c d e")], "doc_id long, text string")).collect()
    assert len(r) == 3 and {(x.doc_id, x.n_lines, x.dropped) for x in r} == {(1, 2, "3"), (None, 1, "")}


def test_lines_are_made_once(spark):
    """A text is put into normal form once (before: again for a filter on the number of its lines)."""
    plan = line_dedup.text_lines(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1


def test_mixing(spark, docs, odd):
    for d in (docs, odd):
        rows = mixing.mix_report(d).collect()
        assert len(rows) == d.count()
        by, size = defaultdict(int), defaultdict(int)
        for r in rows:
            assert r.taken in (0, r.size, 2 * r.size)
            by[r.source_size, r.target] += r.taken
            size[r.source_size, r.target] += r.size
        assert sum(t for _, t in by) <= 1.5 * sum(r.size for r in rows) + 1e-6
    rows = mixing.mix_report(docs).collect()
    most = max(r.size for r in rows)
    taken = defaultdict(int)
    for r in rows:
        taken[r.source_size, r.target] += r.taken
    assert all(abs(k[1] - v) <= most for k, v in taken.items())
    assert abs(sum(t for _, t in taken) - 1.5 * sum(r.size for r in rows)) < 1e-3
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix_report(docs.repartition(7)).collect()))


def test_columns_of_any_name_survive(spark, docs):
    """Every name that an operator or a stage adds or uses inside, as a column of the table."""
    names = """shard slot shard_ slot_ row h none s b n k f p at before all start size bucket copies copy hash target source_size below prefix need in_it taken doc x
        score score_ held_out predicted mask items n_words n_hit mask_ words text_ _d unit comp gid whole first parts list pivot a id shingles _gone least component_id
        secret_base secret_spans base spans _t dropped n_lines line_no _gone_ th clean kept group_size keep_id digit rest sha chars""".split()
    d = docs.filter("doc_id < 60").withColumns({n: F.concat(F.lit(n), "doc_id") for n in names})
    want = {r.doc_id: r for r in d.collect()}
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    made = {
        "toxic": toxicity.drop_toxic(d, labels), "near": jaccard_join.drop_near_copies(d), "decont": decontaminate.decontaminate(d, bench),
        "spans": decontaminate.decontaminate(d, bench, "spans"), "mix": mixing.mix_documents(d), "exact": exact_dedup.drop_exact_copies(d),
        "lines": line_dedup.drop_lines(d), "redact": secrets.redact_secrets(d),
    }
    for name, out in made.items():
        assert out.columns == d.columns, name
        rows = out.collect()
        assert rows and all(tuple(r[c] for c in names) == tuple(want[r.doc_id][c] for c in names) for r in rows), name
    for f in (sharding.interleave_shards, lambda x: toxicity.score_documents(x, toxicity.train(x, labels)), lambda x: decontaminate.mark_contamination(x, bench), secrets.scan_secrets):
        out = f(d)
        assert out.columns[: len(d.columns)] == d.columns and len(set(out.columns)) == len(out.columns)
        assert all(tuple(r[c] for c in names) == tuple(want[r.doc_id][c] for c in names) for r in out.collect())
    for f in (secrets.secret_report, line_dedup.line_report, mixing.mix_report, sharding.shard_report, jaccard_join.component_report, exact_dedup.radix_groups):
        assert sorted(map(str, f(d).collect())) == sorted(map(str, f(d.select("doc_id", "text", "source")).collect()))


def test_source_targets_equal_repeated_sharing(spark):
    sizes = {"a": 10, "b": 1000, "c": 300, "d": 5, None: 400}
    d = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    fixed, left = {}, 1.5 * sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        f = left / sum(weight[s] for s in free)
        over = [s for s in free if f * weight[s] > 2 * sizes[s]]
        if not over:
            break
        for s in over:
            fixed[s] = 2.0 * sizes[s]
            left -= fixed[s]
    want = {s: fixed.get(s, f * weight[s]) for s in order}
    got = {r.source: r.target for r in mixing.source_targets(d).collect()}
    assert got == pytest.approx(want)


def test_sharding(spark, docs, odd):
    rows = sharding.shard_report(docs).collect()
    n = Counter(r.shard for r in rows)
    assert set(n) == set(range(40)) and max(n.values()) - min(n.values()) <= 1
    for s in n:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(n[s]))
    crc = {r.doc_id: zlib.crc32((r.text or "").encode()) for r in docs.collect()}
    assert all(r.text_crc32 == crc[r.doc_id] for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, sharding.shard_report(docs.repartition(5)).collect()))
    few = sharding.interleave_shards(odd, 3)
    assert few.columns == [*odd.columns, "shard_", "slot"] and {r.shard for r in few.collect()} == {None, 9}
    assert sorted(Counter(r.shard_ for r in few.collect()).values()) == [3, 3, 3]
    assert Counter(map(str, few.select(*odd.columns).collect())) == Counter(map(str, odd.collect()))


def test_every_shard_has_the_mixture(spark, monkeypatch):
    rows = [(i, "x" * (i % 7), ("a", "a", "a", "b", None, "c", "a")[i % 7], i // 3) for i in range(1500)] + [(None, "x", "a", 0)] * 100 + [(3, None, None, 0)] * 50
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, n long")
    for bucket in (40, 100_000):
        monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket)
        got = Counter((r.source, r.shard) for r in sharding.interleave_shards(d, 7).collect())
        for s in ("a", "b", "c", None):
            n = sum(1 for r in rows if r[2] == s)
            assert all(abs(got[s, k] - n / 7) < 2 for k in range(7)), s


def test_sharding_with_a_source_for_nearly_every_row(spark, monkeypatch):
    """Sources with fewer rows than there are buckets, beside one with more; prefix sums over several blocks."""
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 20)
    monkeypatch.setattr(sharding, "PREFIX_BLOCK", 4)
    rows = [(i, "big" if i % 3 == 0 else f"s{i // 5}") for i in range(900)]
    got = sharding.interleave_shards(spark.createDataFrame(rows, "doc_id long, source string"), 7).collect()
    assert sorted(r.doc_id for r in got) == list(range(900))
    n = Counter(source for _, source in rows)
    order = sorted(((2 * k - 1) / (2 * n[s]), s) for s in n for k in range(1, n[s] + 1))
    cuts = [-(-900 * k // 7) for k in range(8)]
    assert [len([r for r in got if r.shard == k]) for k in range(7)] == [b - a for a, b in zip(cuts, cuts[1:])]
    assert {(r.shard, r.slot): r.source for r in got} == {(k, i - cuts[k]): order[i][1] for k in range(7) for i in range(cuts[k], cuts[k + 1])}


def sets_of(rows):
    out = {}
    for i, t in rows:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "").encode().split()
        out[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    return out


def brute_components(rows):
    sets = sets_of(rows)
    comp = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(comp[a], comp[b])
            changed |= comp[a] != m or comp[b] != m
            comp[a] = comp[b] = m
    return {i: (len(sets[i]), comp[i]) for i in ids}


def test_jaccard_components(spark, docs, monkeypatch):
    random.seed(5)
    base = [f"w{i}" for i in range(120)]
    near = []
    for i in range(90):  # a chain of ever more edits, and a star around the base
        w = list(base) if i % 3 else near[-1][1].split() if near else list(base)
        for _ in range(random.randint(0, 4)):
            w[random.randrange(len(w))] = f"x{random.randrange(10**6)}"
        near.append((10_000 + i, " ".join(w)))
    rows = [(r.doc_id, r.text) for r in docs.collect()] + near + [(-1, None), (-2, " "), (-3, "one two"), (-4, "ONE  two")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.component_report(d).collect()} == want
    for changed in ({"HOT": 5, "FEW_PAIRS": 0, "MOST_BROADCAST": 0}, {"HOT": 3, "LEAST_BITS": 6, "MOST_BITS": 7, "PIVOT_ROUNDS": 1}):
        with monkeypatch.context() as m:
            for name, value in changed.items():
                m.setattr(jaccard_join, name, value)
            assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.component_report(d).collect()} == want
    kept = jaccard_join.drop_near_copies(d.selectExpr("*", "doc_id AS unit", "text AS component_id", "1 AS _gone", "2 AS least")).collect()
    assert {r.doc_id for r in kept} == {c for _, c in want.values()} and all(r.unit == r.doc_id and r["_gone"] == 1 for r in kept)


def test_jaccard_of_repeated_ids(spark):
    """A doc_id with several texts links what they are linked with; repeated rows count once."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(5, a), (9, a + " more"), (5, b), (7, b + " more"), (7, b + " more"), (8, c), (8, c), (None, a), (4, None), (3, "")]
    got = sorted(jaccard_join.component_report(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=str)
    want = [(5, 36, 5), (9, 37, 5), (5, 36, 5), (7, 37, 5), (7, 37, 5), (8, 36, 8), (8, 36, 8), (None, 36, None), (4, 0, 4), (3, 0, 3)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_jaccard_boilerplate_makes_no_pairs(spark, monkeypatch):
    """Unlinked texts that share most of their words: no pair of them becomes a row (before: 31,600, one for each
    shared shingle of the prefixes). One word changed inside still links."""
    body = [f"b{i}" for i in range(104)]
    rows = [(i, " ".join([*body, *(f"u{i}-{k}" for k in range(13))])) for i in range(80)]
    rows += [(100 + i, " ".join([*body[:50], f"e{i}", *body[51:], *(f"u{i}-{k}" for k in range(13))])) for i in range(5)]
    made, meetings = [], jaccard_join._meetings
    monkeypatch.setattr(jaccard_join, "_meetings", lambda *a: made.append(meetings(*a).count()) or meetings(*a))
    got = jaccard_join.component_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)
    assert made and sum(made) <= 5


def test_jaccard_family_meets_once_a_pair(spark, monkeypatch):
    """Edited copies of one text, about half of the pairs below the bar: a pair is met about once (before: 4,160 rows for 459
    pairs, one for each shingle they share early), and a second pivot joins some of what the first left apart."""
    random.seed(3)
    base, rows = [f"b{i}" for i in range(300)], []
    for i in range(70):
        w = list(base)
        for j in random.sample(range(300), random.randint(2, 14)):
            w[j] = f"e{i}-{j}"
        rows.append((i, " ".join(w)))
    made, meetings = [], jaccard_join._meetings
    monkeypatch.setattr(jaccard_join, "_meetings", lambda *a: made.append((meetings(*a).count(), meetings(*a).select("g", "h").distinct().count())) or meetings(*a))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    for few in (10**9, 0):
        monkeypatch.setattr(jaccard_join, "FEW_PAIRS", few)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.component_report(d).collect()} == brute_components(rows)
    (n, pairs), (after, _) = made
    assert pairs > 100 and n <= 1.5 * pairs and after < 0.7 * n


def test_toxicity_separates_planted_words(spark):
    random.seed(2)
    rows, labels = [], []
    for i in range(600):
        w = ["".join(random.choice("aeiounrst") for _ in range(5)) for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            w[random.randrange(40)] = w[0] = random.choice(["zzgrob", "zzgrobber", "zzgrobest"])
        rows.append((i, " ".join(w)))
        labels.append((i, 0, int(bad)))
    out = toxicity.toxicity_report(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    held = [r for r in out.collect() if r.held_out]
    assert len(held) > 50 and sum((r.predicted == 1) == (r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


@pytest.mark.parametrize("folds", [(1, 2), (3, 3), (2,), (4,)])
def test_toxicity_scores_wherever_the_toxic_labels_fall(spark, folds):
    ids = iter(range(1000))
    toxic = [next(i for i in ids if zlib.crc32(str(i).encode()) % 5 == f) for f in folds]
    rows = [(i, "zzgrob zzgrobber zzgrobest" if i in toxic else f"plain word number {i} of many") for i in range(60)] + [(60, None), (2001, "zzgrob zzgrobber")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, int(i in toxic)) for i in range(60)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in toxicity.toxicity_report(d, labels).collect()}
    assert got[2001] > 0 and got[2001] > max(got[i] for i in range(60) if i not in toxic)


def test_toxicity_counts_all_strings(spark):
    rows = [(k, "abc abd" if k % 2 else "xyz", k % 2, 1 + k % 4) for k in range(8)]
    found, counts = toxicity._string_counts(spark.createDataFrame(rows, "doc_id long, text string, toxic int, fold int"))
    want = defaultdict(lambda: [[0, 0] for _ in range(4)])
    for _, text, c, k in rows:
        for w in text.split():
            s = "\x02" * 4 + w + "\x03"
            for i in range(len(s) - 4):
                want[s[i : i + 5]][k - 1][c] += 1
    assert dict(zip(found, counts.tolist(), strict=True)) == want
    assert not hasattr(toxicity, "MOST_STRINGS")


def test_kneser_ney_probabilities_sum_to_one():
    counts = {"aaaab": (3, 1), "aaaac": (0, 2), "baaab": (2, 0), "abcab": (1, 5), "bcaba": (0, 1), "cabab": (4, 0)}
    strings, contexts = toxicity.kneser_ney_ratios(counts)
    assert strings["aaaac"] > 0 > strings["baaab"] and set(contexts) == {"aaaa", "baaa", "abca", "bcab", "caba"}
    p, back = toxicity.kneser_ney(counts)
    for h in ("aaaa", "baaa", "abca", "bcab", "caba", "cccc", "zabc"):
        for c in (0, 1):
            # The characters that end some string, and all others together.
            assert sum(p(c, h + x) for x in "abc?") == pytest.approx(1)
            assert h in contexts or back(c, h) == 1


def test_exact_dedup(spark, docs, odd):
    for d in (docs, odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])):
        got = {r.doc_id: r for r in exact_dedup.radix_groups(d).collect()}
        groups = defaultdict(list)
        for r in d.collect():
            groups[re.sub("[ \t-\r]+", "", r.text or "")].append((-len(r.text or ""), r.doc_id))
        for text, g in groups.items():
            for _, i in g:
                r = got[i]
                assert (r.keep_id, r.group_size, r.kept) == (min(g)[1], len(g), i == min(g)[1])
                assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert exact_dedup.radix_groups(odd).count() == len(ODD)


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_equals_its_sql_twin(spark, name, sf):
    assert result_rows(QUERIES[name](spark, sf)) == twin(ORACLE[name], sf)


def test_decontamination(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").unionAll(spark.createDataFrame([(900, "word1 Word2"), (901, None), (902, "?!"), (903, LONG)], "item_id long, text string"))
    d = docs.select("doc_id", "text").unionAll(spark.createDataFrame([(-1, "word1, word2 x"), (-2, None), (-3, LONG[100:9000])], "doc_id long, text string"))
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = defaultdict(set)
    for r in bench.collect():
        w = words(r.text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(str(r.item_id))
    want = {}
    for r in d.collect():
        w, hit, items = words(r.text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    items |= windows[k]
        want[r.doc_id] = (len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit))
    assert {r.doc_id: tuple(r)[1:] for r in decontaminate.contamination_report(d, bench).collect()} == want
    blocks = decontaminate.mark_contamination(d, bench, most_windows=900)
    assert {r.doc_id: (r.n_words, r.n_hit, len(r["items"])) for r in blocks.collect()} == {k: v[:3] for k, v in want.items()}
    assert decontaminate.decontaminate(d, bench, "spans").filter("doc_id = -1").first().text == " x"


def test_html(spark):
    long = "Some words of the article that go on for a while. " * 8
    page = f"<html><head><title>T</title></head><body class='sidebar-left'><nav><a href=/>Home</a></nav><article><h1>Ti&amp;tle</h1><div class=ad>buy</div><p>{long}<p>short<br>one<form>f</form></article><footer>end</footer>"
    assert html_text.main_text(page) == "\n\n".join(["Ti&tle", long.strip(), "short one"])
    plain = f"<body><div id=menu>Home About</div><h1>Head</h1><p>{long}</p><p>{long}</p><div class='comments'><p>{long}</p></div>"
    assert html_text.main_text(plain) == "\n\n".join(["Head", long.strip(), long.strip()])
    assert html_text.main_text(None) == html_text.main_text("<p>") == ""
    d = spark.createDataFrame([(1, "u", page), (2, None, None)], "page_id long, url string, html string")
    assert {r.page_id: r.n_chars for r in html_text.page_report(d).collect()} == {1: len(html_text.main_text(page)), 2: 0}


def test_html_keeps_article_text_under_slugs():
    long = "Some words of the article that go on for a while. " * 8
    body = [
        "<h2 id='search-methods'>Search methods</h2>", "<h2 id=notice>Notice</h2>", f"<section id='related-work'><h3>Related work</h3><p>{long}</p></section>",
        "<div class='social-impact'><p>Small.</p></div>", "<p class='notice'>Take note.</p>", "<section id='search'><p>Seek.</p></section>", f"<div class='login-guide'><p>{long}</p></div>",
    ]
    off = "<div class='ad'>buy</div><div class='share big'>tell</div><div id='comments'><p>me too</p></div><ul class='related-links'><li><a href=/1>One more</a></li><li><a href=/2>And two</a></li></ul>"
    page = f"<body><article><div class='article-header'><h1>Title</h1></div><p>{long}</p>{''.join(body)}{off}<p>{long}</p></article></body>"
    want = ["Title", long, "Search methods", "Notice", "Related work", long, "Small.", "Take note.", "Seek.", long, long]
    assert html_text.main_text(page) == "\n\n".join(w.strip() for w in want)


def test_html_takes_time_in_proportion():
    n = 50_000
    pages = ["<div>" * n + "</b>" * n + "x", "<div class='ad-x'>" * n + "<a>x</a>" * n, "<div>x" * n, "<b><article>" + "<div>" * n + "</b>" * n + "x", "<p>" + "x<i>" * n]
    began = time.time()
    assert all(html_text.main_text(p) for p in pages)
    assert time.time() - began < 30


def test_html_columns_and_empty_tables(spark):
    schema = "page_id long, url string, html string, text string, n_chars int"
    page = "<body><article><p>Said &amp; done.</p></article>"
    out = html_text.extract_text(spark.createDataFrame([(1, "u", page, "mine", 5), (None, None, "", None, None)], schema))
    assert out.columns == ["page_id", "url", "text", "n_chars", "text_"]
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "u", "mine", 5, "Said & done."), (None, None, None, None, "")]
    assert html_text.page_report(spark.createDataFrame([], schema)).count() == 0


def test_html_ratios_choose_the_content():
    long = "Some words of the article that go on for a while. " * 8
    said = long.strip()
    nav = "<nav><a href=/>Home</a></nav>"
    links = "<ul><li><a href=/1>One more</a></li><li><a href=/2>And two</a></li><li><a href=/3>Three</a></li></ul>"
    bare = f"<body>{nav}<div class=page><h1>Head</h1><p>A lede.</p><p>By <a href=/ann>Ann Other</a></p><div class=text>{f'<p>{long}</p>' * 5}</div><p>The end.</p>{links}</div><footer>x</footer>"
    assert html_text.main_text(bare) == "\n\n".join(["Head", "A lede.", "By Ann Other", *[said] * 5, "The end."])
    teaser = f"<body>{nav}<div class=story><p>Lede.</p>{f'<p>{long}</p>' * 6}<p>End.</p></div>{links}<article><p>Read this too.</p></article>"
    assert html_text.main_text(teaser) == "\n\n".join(["Lede.", *[said] * 6, "End."])
    several = f"<body>{nav}" + "".join(f"<article>{x}</article>" for x in (f"<p>{long}</p>" * 2, "<p>Short.</p>", f"<p>{long}</p>" * 2)) + links
    assert html_text.main_text(several) == "\n\n".join([said, said, "Short.", said, said])
    sole = f"<body>{links}<main>{links}<article><p>Lede.</p>{f'<p>{long}</p>' * 3}<p>End.</p></article></main>"
    assert html_text.main_text(sole) == "\n\n".join(["Lede.", *[said] * 3, "End."])


def test_chat_format_round_trip(spark):
    random.seed(3)
    bits = ["<|end|>", "\n", "\\", "<\\|", "[INST]", "[\\/INST]", "</s>", "<\\n>", "é", "word ", "<|start|>assistant\n", "<", "[", "|", "<s>", " a b c", "\\\\"]
    text = lambda n: "".join(random.choice(bits) for _ in range(random.randint(0, n)))
    roles = ["user", "assistant", "system", "a\nb", None, "<\\n>", "x<|end|>"]
    rows = [(c, None if random.random() < 0.05 else t, random.choice(roles), random.choice([None, text(8), text(2000)])) for c in range(20) for t in range(random.choice([1, 3, 20]))]
    rows += [(99, t, random.choice(["user", "assistant"]), text(30)) for t in range(4500)] + [(99, 10, "system", "be nice"), (None, 0, "assistant", "x"), (None, 0, "assistant", "x")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = defaultdict(list)
    for c, t, r, x in [*rows, (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]:
        want[c].append((-1 if t is None else t, r or "", x or ""))
    for r in chat_format.conversation_report(d).collect():
        turns = sorted(want.pop(r.conv_id))
        loss = "".join(x for _, role, x in turns if role == "assistant")
        assert r.n_turns == len(turns) and r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{x}\n" for _, a, x in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert not want
    again = chat_format.format_conversations(d).filter("conv_id = 99 AND block = 1")
    assert again.filter("NOT startswith(formatted, '<|again|>system\nbe nice<|end|>')").count() == 0


def test_pipeline_stages(spark, docs):
    clean = corpus_pipeline.toxicity(spark, docs, SF)
    scores = {r.doc_id for r in QUERIES["op7_toxicity"](spark, SF).collect() if not r.predicted}
    assert {r.doc_id for r in clean.collect()} == scores
    kept = corpus_pipeline.near_copies(spark, clean, SF)
    comps = brute_components([(r.doc_id, r.text) for r in clean.collect()])
    assert {r.doc_id for r in kept.collect()} == {c for _, c in comps.values()}
    pure = corpus_pipeline.decontamination(spark, kept, SF)
    bad = {r.doc_id for r in QUERIES["op9_decontamination"](spark, SF).collect() if r.contaminated}
    assert {r.doc_id for r in pure.collect()} == {r.doc_id for r in kept.collect()} - bad
    mixed = corpus_pipeline.mixing(spark, pure, SF)
    want = Counter({r.doc_id: r.taken // r.size for r in mixing.mix_report(pure).collect() if r.taken})
    assert Counter(r.doc_id for r in mixed.collect()) == want and mixed.columns == docs.columns
    shards = Counter(r.shard for r in corpus_pipeline.sharding(spark, mixed, SF).collect())
    assert sum(shards.values()) == sum(want.values()) and max(shards.values()) - min(shards.values()) <= 1
    assert corpus_pipeline.run(spark, SF).count() == sum(want.values())
