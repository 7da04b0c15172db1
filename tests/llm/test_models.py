"""Toxicity scores against plain Kneser-Ney sums, and time in proportion to long texts and deep pages."""

import math
import random
import time
from collections import Counter

import pytest

from chatloom.llm import chat_format, html_text, toxicity


def plain_ratio(words_by_class, word):
    """log P(word | toxic) - log P(word | ordinary) by the recursion as it is written down."""
    n, d = toxicity.ORDER, toxicity.DISCOUNT
    grams = [Counter(), Counter()]
    for c in (0, 1):
        for w in words_by_class[c]:
            s = "\x02" * (n - 1) + w + "\x03"
            grams[c].update(s[i : i + n] for i in range(len(s) - n + 1))
    both = set(grams[0]) | set(grams[1])

    def before(g):
        """Different characters that stand before g in strings one longer."""
        longer = {x[len(x) - len(g) - 1 :] for x in both if x.endswith(g)} if len(g) == n - 1 else {h for h in shorter(len(g) + 1) if h.endswith(g)}
        return len({x[0] for x in longer if x[1:] == g})

    def shorter(k):
        return {x[n - k :] for x in both}

    def q(g):
        if not g:
            return 1 / (len(shorter(1)) + 1)
        same = [x for x in shorter(len(g)) if x[:-1] == g[:-1]]
        total = sum(before(x) for x in same)
        if not total:
            return q(g[1:])
        return (max(before(g) - d, 0) + d * len(same) * q(g[1:])) / total

    def p(c, g):
        same = [x for x in grams[c] if x[:-1] == g[:-1]]
        total = sum(grams[c][x] for x in same)
        if not total:
            return q(g[1:])
        return max(grams[c][g] - d, 0) / total + d * len(same) / total * q(g[1:])

    s = "\x02" * (n - 1) + word + "\x03"
    return sum(math.log(p(1, s[i : i + n]) / p(0, s[i : i + n])) for i in range(len(s) - n + 1))


def test_word_ratios_equal_the_plain_recursion():
    random.seed(2)
    make = lambda: "".join(random.choice("abcé") for _ in range(random.randint(1, 7)))
    words = [[make() for _ in range(25)], [make() + "ab" for _ in range(15)]]
    counts = {}
    for c in (0, 1):
        for w in words[c]:
            s = toxicity._PAD + w + toxicity._STOP
            for i in range(len(s) - toxicity.ORDER + 1):
                g = s[i : i + toxicity.ORDER]
                counts[g] = tuple(counts.get(g, (0, 0))[k] + (k == c) for k in (0, 1))
    ratios = toxicity.WordRatios(*map(toxicity.packed, toxicity.kneser_ney_ratios(counts)))
    asked = [*words[0][:15], *words[1][:15], *[make() for _ in range(20)], "zz", "abz", "z" * 70]
    want = [plain_ratio(words, w) for w in asked]
    for at_once, most in ((1 << 18, 100), (20, 10)):
        ratios.AT_ONCE, ratios.MOST = at_once, most
        assert ratios.of(asked).tolist() == pytest.approx(want, abs=1e-9)
        assert "z" * 70 not in ratios
    nothing = toxicity.WordRatios(toxicity.packed({}), toxicity.packed({}))
    assert nothing.of(["a", "bc"]).tolist() == [0, 0]


def test_a_long_labelled_word_takes_time_in_proportion(spark):
    random.seed(3)
    long = "".join(random.choice("abcdefgh") for _ in range(1_000_000))
    rows = [(k, f"plain words {k}", 0, 1 + k % 4) for k in range(40)] + [(k, "zzgrob zzgrobber", 1, 1 + k % 4) for k in range(40, 60)] + [(99, long, 0, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int, fold int")
    began = time.time()
    found, counts = toxicity._string_counts(df)
    assert time.time() - began < 30
    s = toxicity._PAD + long + toxicity._STOP
    want = Counter(s[i : i + 5] for i in range(len(s) - 4))
    got = dict(zip(found, counts[:, 0, 0].tolist(), strict=True))
    assert all(got[g] == n for g, n in want.items() if "plain"[:3] not in g and "word" not in g)


def test_deep_pages_take_time_in_proportion():
    n = 30_000
    pages = {
        "<article>" * n + "<p>text of it": "text of it", "<div>" * n + "<main>" * n + "<p>some": "some", "<nav><b><article>" * n + "<p>x": "x",
        "<article>" + "<header><h1>t</h1>" * n + "</header>" * n + "<p>y": "t\n\ny", "<p><i>" * n + "<article>text": "text",
    }
    began = time.time()
    for html, text in pages.items():
        assert html_text.main_text(html) == text, html[:30]
    assert time.time() - began < 40


def test_teasers_after_the_content_are_left_out():
    page = "<body><div id=main><h1>T</h1>" + "<p>A paragraph with some words in it, and more of them.</p>" * 3 + "</div><div class='teaser'><a href=x>Read this too</a></div></body>"
    assert html_text.main_text(page).endswith("more of them.")


def test_no_conversations_leave_the_added_one(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string, formatted string")
    rows = chat_format.conversation_report(none).collect()
    assert [(r.conv_id, r.n_turns) for r in rows] == [(-7, 2)]
    assert html_text.page_report(spark.createDataFrame([(None, None, None)], "page_id long, url string, html string")).first().n_chars == 0
