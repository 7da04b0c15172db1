"""Main text of generated pages whose text is known: with an article, with main, in a plain box beside furniture with telling
names, and beside furniture without any."""

import math
import random

import pytest

from chatloom.llm import html_text


def words(r, n):
    return " ".join("".join(r.choice("abdefghilmnoprstuvé<&") for _ in range(r.randint(2, 9))) for _ in range(n))


def esc(r, text):
    forms = {"<": ["&lt;"], "&": ["&amp;", "&#38;", "&#x26;"], "é": ["é", "&eacute;", "&#233;"]}
    return "".join(r.choice(forms.get(c, [c])) for c in text)


def page(r, kind):
    """(html, text)"""
    said = lambda n: esc(r, words(r, n))
    par = lambda text: f"<p>{esc(r, text)}" + r.choice(["</p>", "</p>", "</p>", ""])
    link = lambda: f"<a href=/{r.randint(1, 99)}>{said(r.randint(1, 3))}</a>"
    links = lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(r.randint(3, 7))) + "</ul>"
    off = [
        lambda: f'<div class="ad">{par(words(r, 12))}</div>', lambda: f"<aside>{par(words(r, 20))}</aside>", lambda: f"<form><input>{said(1)}</form>",
        lambda: "<script>var x='<p>no</p>';</script>", lambda: f"<div class='share'>{link()}</div>", lambda: "<!-- <p>no</p> -->", lambda: "<style>p{}</style>",
    ]
    title = words(r, r.randint(3, 8))
    body, want = [f"<h1>{esc(r, title)}</h1>"], [title]
    for _ in range(r.randint(4, 9)):
        short = kind in ("article", "main") and r.random() < 0.3
        text, style = words(r, r.randint(4, 9) if short else r.randint(40, 120)), r.random()
        if style < 0.15:
            want.append(words(r, 3))
            body.append(f"<h2>{esc(r, want[-1])}</h2>")
        want.append(text)
        body.append(f"<blockquote>{par(text)}</blockquote>" if style > 0.9 else f"<p><b>{esc(r, text)}</b><br></p>" if style > 0.8 else par(text))
        if kind == "article" and r.random() < 0.3:
            body.append(r.choice(off)())
    before = f"<nav>{links()}</nav><header>{link()}</header>"
    after = f"<div class='sidebar'>{links()}</div><section class='comments'>{par(words(r, 40))}{par(words(r, 9))}</section><footer>{par(words(r, 10))}</footer>"
    if kind in ("article", "main"):
        before += f"<div id='cookie-notice'>{par(words(r, 15))}</div>"
    if kind == "nameless":
        before = f"<div class=a1>{links()}</div><div class=a2>{link()} {link()}</div>"
        after = f"<div class=z1>{links()}</div><div class=z2>{''.join(f'<div>{said(2)} {link()}</div>' for _ in range(4))}</div><div class=z3>{said(5)} {link()} {link()}</div>"
    tag = kind if kind in ("article", "main") else "div"
    wrap = r.choice(["{}", "<div id=page>{}</div>", "<table><tr><td>{}</td></tr></table>"])
    whole = wrap.replace("{}", before + f"<{tag}>" + "\n".join(body) + f"</{tag}>" + after)
    return f"<!doctype html><html><head><title>{esc(r, title)}</title></head><body>{whole}</body></html>", "\n\n".join(want)


@pytest.mark.parametrize("kind", ["article", "main", "plain", "nameless"])
def test_generated_pages(kind):
    for seed in range(150):
        html, want = page(random.Random(f"{kind}{seed}"), kind)
        assert html_text.main_text(html) == want, (kind, seed)


@pytest.mark.parametrize("bar", [-math.inf, math.inf])
def test_the_threshold_decides_where_nothing_has_a_telling_name(monkeypatch, bar):
    pages = [page(random.Random(f"nameless{seed}"), "nameless") for seed in range(50)]
    monkeypatch.setattr(html_text, "threshold", lambda values: bar)
    assert all(html_text.main_text(html) != want for html, want in pages)
