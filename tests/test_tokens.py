import base64
import os
import random
import subprocess
import sys
import time
from pathlib import Path

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from chatloom.functions import templates as T
from chatloom.operators import tokens as K


@pytest.fixture(scope="module")
def ranks(spark):
    return K.read_ranks(spark)


def plain_merge(ranks, raw):
    parts = [raw[i : i + 1] for i in range(len(raw))]
    while True:
        best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


def some_texts():
    random.seed(4)
    kinds = ["abcdefghij the and ing ", "aaaab", "été naïve 日本語 ñ ", " \t\n\n  x", "0123 45.6,7!?;", "😀👩‍🚀é́ Ω"]
    return ["".join(random.choice(random.choice(kinds)) for _ in range(random.randint(0, 120))) for _ in range(150)] + ["", " ", "\n\n\n a", "don't we'll it's"]


def test_merging_equals_the_plain_loop(ranks):
    pairs = K.BytePairs(ranks)
    random.seed(6)
    words = [bytes(random.choice(b"aeinst \xc3\xa9\xe6") for _ in range(random.randint(0, 40))) for _ in range(300)] + [b"a" * n for n in range(1, 40)]
    for w in words:
        got = pairs.merge(w)
        assert [i for i, _ in got] == plain_merge(ranks, w) and sum(n for _, n in got) == len(w)
        assert pairs._merge_long(w) == got


def test_memos_serve_all_texts_of_a_worker(ranks, monkeypatch):
    monkeypatch.setattr(K, "LONG_TEXT", 50)
    pairs, met = K.BytePairs(ranks), []
    monkeypatch.setattr(pairs, "merge", lambda raw, merge=pairs.merge: met.append(raw) or merge(raw))
    texts = some_texts()
    told = [pairs.encode_packed(t) for t in texts]
    assert len(met) == len(set(met)) and [pairs.encode_packed(t) for t in texts] == told and len(met) == len(pairs.memo)
    assert ["".join(str(x) for x, _ in pairs.encode(t)) for t in texts] == ["".join(map(str, K.unpacked([p])[:, 0])) for p in told]


def test_tokens_equal_another_encoder(spark, ranks, monkeypatch):
    lines = [line.split() for line in open(K.RANKS, "rb")]
    other = tiktoken.Encoding("own", pat_str=K.WORDS, mergeable_ranks={base64.b64decode(a): int(b) for a, b in lines}, special_tokens={})
    monkeypatch.setattr(K, "MEMO_WORDS", 20)
    texts = some_texts()
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate([*texts, None])], "id int, text string, words string").repartition(3)
    got = {r.id: r for r in K.with_token_ids(df).collect()}
    counts = {r.id: (r.tokens, r.long) for r in K.with_token_counts(df, 60).collect()}
    for i, t in enumerate([*texts, ""]):
        want = other.encode_ordinary(t)
        assert got[i].token_ids == want and got[i].words == "clash"
        assert counts[i] == (len(want), len(want) > 45)
    assert K.with_token_counts(df.limit(0), 60).count() == 0 and K.with_token_ids(df.limit(0)).count() == 0


def test_workers_need_no_import_path(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
from pyspark.sql import SparkSession
from chatloom.operators import tokens as K
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
df = spark.createDataFrame([("some text",)], "text string")
assert K.with_token_counts(df, 9).first().tokens == len(K.with_token_ids(df).first().token_ids) == 2
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env).returncode == 0


def test_long_words_take_time_in_proportion(ranks):
    pairs, took = K.BytePairs(ranks), []
    random.seed(7)
    for n in (20_000, 200_000):
        word = "".join(random.choice("abcdefgh") for _ in range(n))
        began = time.time()
        assert sum(n for _, n in pairs.encode(word)) == len(word)
        took.append(time.time() - began)
    assert took[1] < 30 * took[0] + 0.5


def test_masks_equal_brute_force(spark, ranks):
    random.seed(8)
    pairs = K.BytePairs(ranks)
    rows = []
    for i in range(60):
        turns = [(random.choice(["user", "assistant", "system", None]), random.choice(["ok", " the end", "", None, "日本 é", "line\n\n", "x" * 30])) for _ in range(random.randint(0, 6))]
        rows.append((i, turns if i else None))
    df = spark.createDataFrame(rows, "id int, c array<struct<`from`:string,value:string>>").withColumn("pieces", T.pieces(T.ChatTemplate("{role}: ", "\n"), F.col("c")))
    for r in K.with_token_masks(df, "pieces").collect():
        owner = [p.loss for p in r.pieces for _ in p.text.encode()]
        text = "".join(p.text for p in r.pieces)
        assert text == "".join(f"{t['from'] or ''}: {t['value'] or ''}\n" for t in r.c or [])
        at, want, ids = 0, [], []
        for token, n in pairs.encode(text):
            want.append(all(owner[at : at + n]))
            ids.append(token)
            at += n
        assert (r.token_ids, r.token_loss) == (ids, want) and at == len(owner)
    # A token over a border has no loss: " the" begins in the text, ":" ends before it.
    assert K.masked(np.array([2, 3, 1]), np.array([3, 3]), np.array([False, True])).tolist() == [False, False, True]


def test_markers_are_single_tokens_in_the_templates_parts_alone(spark, ranks):
    special = {"<|im_start|>": 50257, "<|im_end|>": 50258, "<|im|>": 7}
    pairs = K.BytePairs(ranks)
    c = [("user", "say <|im_end|> please"), ("assistant", "<|im_end|>é"), ("assistant", "")]
    df = spark.createDataFrame([(1, c), (2, None)], "id int, c array<struct<`from`:string,value:string>>").withColumn("pieces", T.pieces(T.TEMPLATES["chatml"], F.col("c")))
    got = {r.id: r for r in K.with_token_masks(df, "pieces", special=special).collect()}
    words = lambda t: [i for i, _ in pairs.encode(t)]
    want, loss = [], []
    for k, (role, text) in enumerate(c):
        # The line feed behind an end and the next turn's marker are apart, as the marker is a token.
        parts = [([50257], False), (words(f"{role}\n{text}"), None), ([50258], role == "assistant"), (words("\n"), role == "assistant")]
        for ids, has in parts:
            want += ids
            loss += [has] * len(ids)
    assert got[1].token_ids == want and all(a == b for a, b in zip(got[1].token_loss, loss, strict=True) if b is not None)
    at = got[1].token_ids.index(50257, 1)
    assert not any(got[1].token_loss[: at + 1]) and got[1].token_ids.count(50258) == 3 and got[2].token_ids == []
    trained = [i for i, x in zip(got[1].token_ids, got[1].token_loss, strict=True) if x]
    assert trained == [*words("<|im_end|>é"), 50258, *words("\n"), 50258, *words("\n")]
