"""Main text of web pages: parser events give blocks, text-to-tag ratios tell content from the rest.

The standard library's streaming parser cuts a page into blocks and notes what each lies in. Per block (a page has no
meaningful lines) the ratio of text to tags is smoothed with a Gaussian; two clusters of the smoothed ratios give the
threshold. The innermost element with MOST of the blocks above it is the content and is kept whole, short blocks
included; article and main elements are only a hint where to stop.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import free_names

# Elements by their role in a page, and words in class, id or role that mark a part as not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
NEVER = frozenset("aside audio button canvas datalist dialog footer form head header iframe map math menu nav noscript object option script select style svg template textarea title video".split())
CONTAINERS = frozenset(("article", "main"))
OFF_WORDS = frozenset(
    "ad ads advert advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup "
    "modal overlay sidebar aside nav navbar navigation menu breadcrumb breadcrumbs pagination pager header masthead footer comment comments "
    "disqus respond reply replies share sharing social related recommended teaser teasers newsletter subscribe signup login search widget toolbar skip".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
COMMENT_WORDS = frozenset("comment comments comment-list comment-body comments-area comment-respond disqus disqus_thread respond reply replies".split())
#: Whole names that mark furniture even inside an article; there the other words may name what the text is about.
FURNITURE = COMMENT_WORDS | frozenset(
    "ad ads advert advertisement adsense adsbygoogle sponsored promo share share-buttons sharing social-share social-links newsletter "
    "newsletter-signup related-posts related-articles breadcrumb breadcrumbs pagination cookie-banner cookie-notice cookie-consent skip-link".split()
)
ROLES = frozenset("navigation banner search complementary contentinfo dialog alertdialog menu menubar toolbar".split())
PROSE = HEADINGS | frozenset("p section blockquote pre".split())
NODES = frozenset("body main article section div td center".split())
BOXES = frozenset("div section ul ol dl table".split())
SIGMA = 1.0
MOST, HALF = 0.75, 0.5  # shares of the blocks above the threshold
_split_words = re.compile(r"[^a-z0-9]+").split


class PageBlocks(HTMLParser):
    """Blocks of a page, each [text, tags, node, off, heading, doubt, linked]: node numbers the innermost of NODES (0
    outside), off tells that it lies in furniture, doubt numbers the innermost box with a word of OFF_WORDS as a part of a
    name (0 outside), linked counts characters in links. ``nodes`` has each node's parent and tag, ``doubts`` each box's
    outer box."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[list] = []
        self.nodes: list[tuple[int, str]] = [(0, "")]
        self.doubts = [0]
        self.open: list[tuple[str, bool, bool, int, int]] = []  # tag, switches text off, belongs to reader comments, doubt, node
        self.names: Counter[str] = Counter()  # of open elements
        self.scopes: list[Counter[str]] = [Counter()]  # the same, of those from each open article or main on
        self.loose: list[int] = []  # places in open of what an article or main does not stay in: inline, p, switched off
        self.off_tags: list[str] = []
        self.comments = self.depth = self.tags = self.linked = 0
        self.parts: list[str] = []

    def cut(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            heading = any(x[0] in HEADINGS for x in self.open[-3:])
            title = heading and self.depth and self.off_tags == ["header"]
            doubt, node = self.open[-1][3:] if self.open else (0, 0)
            self.blocks.append([text, self.tags, node, bool(self.off_tags) and not title, heading, doubt, self.linked])
            self.tags = 0
        self.parts, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag not in INLINE:
            self.parts.append(" ") if tag == "br" else self.cut()
        elif tag == "wbr":
            return
        if tag in VOID:
            return
        if tag == "body" and self.names["head"]:
            self._reopen([x for x in self.open if x[0] != "head"])
        names, doubtful = self._names(tag, attrs) if attrs else ((), False)
        comment = not COMMENT_WORDS.isdisjoint(names)
        if tag in CONTAINERS and not comment and not self.comments:
            self._leave_off()  # what was not closed before the article
            self._push(tag, False, False, 0)
            return
        off_names = FURNITURE if self.depth or tag in PROSE else FURNITURE | OFF_WORDS
        off = tag in NEVER or (tag not in ("html", "body") and not off_names.isdisjoint(names))
        if tag == "p":
            if self.open and self.open[-1][0] == "p":
                self._pop()
        doubt = self.open[-1][3] if self.open else 0
        if doubtful:
            self.doubts.append(doubt)
            doubt = len(self.doubts) - 1
        self._push(tag, off, comment, doubt)

    def _push(self, tag: str, off: bool, comment: bool, doubt: int) -> None:
        node = self.open[-1][4] if self.open else 0
        if tag in NODES:
            self.nodes.append((node, tag if not comment else ""))
            node = len(self.nodes) - 1
        self._open((tag, off, comment, doubt, node))

    def _open(self, x: tuple[str, bool, bool, int, int]) -> None:
        if x[1] or x[0] in INLINE or x[0] == "p":
            self.loose.append(len(self.open))
        self.open.append(x)
        if x[1]:
            self.off_tags.append(x[0])
        self.comments += x[2]
        self.names[x[0]] += 1
        if x[0] in CONTAINERS:
            self.depth += not x[1]
            self.scopes.append(Counter())
        self.scopes[-1][x[0]] += 1

    def _pop(self) -> None:
        x = self.open.pop()
        if self.loose and self.loose[-1] == len(self.open):
            self.loose.pop()
        if x[1]:
            self.off_tags.pop()
        self.comments -= x[2]
        self.names[x[0]] -= 1
        if x[0] in CONTAINERS:
            self.depth -= not x[1]
            self.scopes.pop()
        else:
            self.scopes[-1][x[0]] -= 1

    def _reopen(self, kept: list, upto: int = 0) -> None:
        """Put ``kept`` in the place of what is open from ``upto`` on."""
        while len(self.open) > upto:
            self._pop()
        for x in kept:
            self._open(x)

    @staticmethod
    def _names(tag: str, attrs: list) -> tuple[set[str], bool]:
        """The names in class, id and role that may mark furniture, and whether a box leaves doubt. Ids of headings and of
        sections are mostly the words of their titles, so they mark reader comments of sections at most."""
        said = {k: set(v.lower().split()) for k, v in attrs if v and k in ("class", "id", "role")}
        names = said.get("class", set()) | {n for n in said.get("role", ()) if n in ROLES}
        ids = said.get("id", set())
        if tag not in HEADINGS:
            names |= ids & COMMENT_WORDS if tag == "section" else ids
        parts = {w for v in said.values() for n in v for w in _split_words(n)} if tag in BOXES else set()
        return names, not OFF_WORDS.isdisjoint(parts)

    def _leave_off(self) -> None:
        """Close what an article or main does not stay in, and with furniture all inside it but open articles. What comes before
        the first such element is not looked at, so every element is moved once at most."""
        if not self.loose:
            return
        low = self.loose[0]
        tail = self.open[low:]
        at = next((k for k, x in enumerate(tail) if x[1]), len(tail))
        around = [x for x in tail[:at] if x[0] not in INLINE and x[0] != "p"]
        self._reopen(around + [x for x in tail[at:] if x[0] in CONTAINERS and not x[1]], low)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag not in INLINE and tag != "br":
            self.cut()
        # A stray end tag does not close the article.
        if self.names[tag] if tag in ("html", "body") else self.scopes[-1][tag]:
            while self.open[-1][0] != tag:
                self._pop()
            self._pop()

    def handle_data(self, data: str) -> None:
        self.parts.append(data)
        if self.names["a"]:
            self.linked += len("".join(data.split()))

    def unknown_decl(self, data: str) -> None:
        pass


def smooth(values: list[float], sigma: float = SIGMA) -> list[float]:
    r = math.ceil(3 * sigma)
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-r, r + 1)]
    out = []
    for i in range(len(values)):
        near = [(kernel[d + r], values[i + d]) for d in range(-r, r + 1) if 0 <= i + d < len(values)]
        out.append(sum(k * v for k, v in near) / sum(k for k, _ in near))
    return out


def threshold(values: list[float]) -> float:
    """Between the two clusters of the values (two means, from the extremes on)."""
    low, high = min(values), max(values)
    for _ in range(20):
        mid = (low + high) / 2
        a, b = [v for v in values if v <= mid], [v for v in values if v > mid]
        if not b:
            break
        new = sum(a) / len(a), sum(b) / len(b)
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def link_lists(blocks: list[list], outer: list[int], hot: list[bool]) -> None:
    """Switch off the boxes in doubt that have no block above the threshold and consist of links for the greater part."""
    boxes = [[0, 0, False] for _ in outer]
    for b, h in zip(blocks, hot, strict=True):
        if not b[3]:
            box = boxes[b[5]]
            box[0] += b[6]
            box[1] += len("".join(b[0].split()))
            box[2] |= h
    for k in range(len(outer) - 1, 0, -1):  # outer boxes come before inner ones
        linked, chars, any_hot = boxes[k]
        box = boxes[outer[k]]
        box[0] += linked
        box[1] += chars
        box[2] |= any_hot
    off = [False]
    for k in range(1, len(outer)):
        linked, chars, any_hot = boxes[k]
        off.append(off[outer[k]] or (not any_hot and 2 * linked > chars))
    for b in blocks:
        b[3] |= off[b[5]]


def content(page: PageBlocks, hot: list[bool]) -> list[int]:
    """Places of the blocks of the content: the innermost node with MOST of the hot blocks, whole.

    No step goes from an article or main further in, but to an article in it. Where several articles or mains share the
    blocks and together have HALF of them, all of these are the content. Otherwise what lies right before and after the
    node belongs to it, up to what is switched off, a list of links or a cold box in doubt."""
    blocks, nodes = page.blocks, page.nodes
    if not any(hot):
        hot = [not b[3] for b in blocks]
    votes = [0] * len(nodes)
    for b, h in zip(blocks, hot, strict=True):
        votes[b[2]] += h
    for k in range(len(nodes) - 1, 0, -1):  # parents come before their children
        votes[nodes[k][0]] += votes[k]
    total, core = votes[0], 0

    # A node's descendants are numbered from it to its last one; around has its nearest article or main.
    last_in, around = list(range(len(nodes))), [0] * len(nodes)
    for k in range(len(nodes) - 1, 0, -1):
        last_in[nodes[k][0]] = max(last_in[nodes[k][0]], last_in[k])
    for k in range(1, len(nodes)):
        parent = nodes[k][0]
        around[k] = parent if nodes[parent][1] in CONTAINERS else around[parent]

    for k in range(1, len(nodes)):
        if votes[k] >= MOST * total and core <= k <= last_in[core]:
            if nodes[core][1] != "article" and (nodes[core][1] != "main" or nodes[k][1] == "article"):
                core = k
    if nodes[core][1] in CONTAINERS:
        tops = {core}
    else:
        tops = {k for k in range(core + 1, last_in[core] + 1) if nodes[k][1] in CONTAINERS and around[k] <= core}
        if not tops or sum(votes[k] for k in tops) < HALF * votes[core]:
            tops = {core}
    inside = [False] * len(nodes)
    for k in range(len(nodes)):
        inside[k] = k in tops or (k > 0 and inside[nodes[k][0]])
    at = [i for i, b in enumerate(blocks) if inside[b[2]]]
    first, last = at[0], at[-1]
    taken = set(at)
    while first and blocks[first - 1][4] and not blocks[first - 1][3]:
        first -= 1
        taken.add(first)
    if tops == {core} and nodes[core][1] not in CONTAINERS:

        def ends(i: int) -> bool:
            return not 0 <= i < len(blocks) or blocks[i][3] or (blocks[i][5] > 0 and not hot[i])

        def linked(i: int) -> bool:
            return 2 * blocks[i][6] > len("".join(blocks[i][0].split()))

        for i, step in ((first, -1), (last, 1)):
            i += step
            # One linked block between others is a byline, a list of links has more or lies at the edge.
            while not ends(i) and not (linked(i) and (ends(i + step) or linked(i + step))):
                taken.add(i)
                i += step
    return sorted(i for i in taken if not blocks[i][3])


def main_text(html: str | None) -> str:
    """The article's blocks, each with single spaces, joined by two line feeds."""
    page = PageBlocks()
    page.feed(html or "")
    page.close()
    page.cut()
    if all(b[3] for b in page.blocks):
        return ""
    # In logarithms, as a few very long blocks would make a cluster of their own.
    ratios = smooth([math.log1p(len(b[0]) / max(1, b[1])) for b in page.blocks])
    bar = threshold(ratios)
    hot = [r >= bar and not b[3] for r, b in zip(ratios, page.blocks, strict=True)]
    link_lists(page.blocks, page.doubts, hot)
    return "\n\n".join(page.blocks[i][0] for i in content(page, hot))


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` in place of ``html``: one row per page, an empty text where the page has no article
    (also for null and empty pages). Where ``pages`` has a column named text, the new one is ``text_``."""
    kept = [f for f in pages.schema.fields if f.name != html]
    (text,) = free_names(pages.drop(html), "text")
    rows = pages.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{html}`"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h.as_py()) for h in batch.column(len(kept))], pa.string())
            yield pa.record_batch([*batch.columns[:-1], texts], [*batch.schema.names[:-1], text])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], f"{text} string"])
    return rows.mapInArrow(run, schema)


def page_report(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``, repeated ones too: page_id, url, text, n_chars. Null and empty pages and such without an
    article have an empty text and 0; null ids and urls stay; other columns are ignored; an empty table has no rows."""
    out = extract_text(pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
