"""Main text of web pages by a minimum cut over their text blocks.

A page is cut into blocks of text with the elements around them. A classifier turns each block's
evidence (elements, class and id words, links, length) into the capacity of its edge to the content
or to the boilerplate terminal. Smoothness edges join neighbouring blocks and, through one node per
container, blocks that stand in the same container. The maximum flow between the terminals gives
the minimum cut; blocks on the content side are the text.

Where a page marks its article (``article``, ``main``), that is evidence, and what an element around
it is called is not. Elsewhere the place is found by density: blocks gain by the share of unlinked
text that their container has of the page's richest one, and an element that holds most of the
page's unlinked text is not judged by its class.

Defined results: a null html has an empty text; scripts, styles, the head, embedded and hidden
elements are never text; markup that isn't closed ends with its parent or the page, an embedded
element without an end tag holds nothing, and only a script, style, title or textarea without one
takes the rest of the page, as in HTML; attributes follow HTML's rules, so a quote inside an
unquoted value is part of it; every page is parsed whole, in time that grows with its length;
repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

# HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
EMBEDDED = frozenset("noscript template iframe select svg object canvas audio video".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
CLOSED_BY_SAME = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",),
}
SCOPES = frozenset("ul ol menu dl table td th".split())
# Parts of a text: the container that their text counts for is the one around them.
PARTS = frozenset(
    "address blockquote caption dd details dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup li ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
TEXT_PARTS = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre".split())
# Evidence: positive speaks for content.
BOILERPLATE_ELEMENTS = frozenset("nav footer aside form header menu dialog button fieldset".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent "
    "disqus footer header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted "
    "related replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
CONTENT_WORDS = frozenset("article content entry main post story".split())
# Words of a class that says what an element has or does, not what it is.
STATE_WORDS = frozenset("has with without no not is show hide hidden open opened closed enabled disabled toggle".split())
STRONG, CONTENT, LINKS, LENGTH, DENSITY = 9.0, 4.0, 4.0, 0.6, 5.0
NEIGHBOURS, SAME_CONTAINER = 0.6, 0.4
MOST = 0.5  # of the unlinked text of a page without an article: an element with more is the page's frame

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.S)
_ATTRIBUTE = re.compile(r"[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>]*)))?)")
_NAMES = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Block:
    text: str
    element: _Element
    container: int
    linked: int = 0
    evidence: float = 0.0


@dataclass
class _Element:
    tag: str
    number: int
    around: _Element | None
    own: float  # evidence of the element, and of its class and id
    named: float
    article: bool
    hidden: bool
    link: bool
    box: int  # the nearest block element, and the one around that
    outer: int
    frame: _Element | None = None  # the nearest element that is no part of a text
    holds_article: bool = False
    unlinked: int = 0  # characters of text below it, and of its parts
    total: float | None = None
    parts: int = 0


@dataclass
class _Page:
    """Open elements and the blocks so far."""

    blocks: list[Block] = field(default_factory=list)
    open: list[_Element] = field(default_factory=lambda: [_Element("", 0, None, 0.0, 0.0, False, False, False, 0, 0)])
    counts: dict[str, int] = field(default_factory=dict)
    texts: list[str] = field(default_factory=list)
    every: list[_Element] = field(default_factory=list)
    linked: int = 0
    elements: int = 0
    has_article: bool = False

    def text(self, raw: str) -> None:
        here = self.open[-1]
        if raw and not here.hidden:
            raw = entities.unescape(raw) if "&" in raw else raw
            self.texts.append(raw)
            if here.link:
                self.linked += len(raw)

    def flush(self) -> None:
        """Ends the block that is being read."""
        if self.texts:
            text = " ".join("".join(self.texts).split())
            if text:
                self.blocks.append(Block(text, self.open[-1], self.open[-1].outer, min(self.linked, len(text))))
            self.texts, self.linked = [], 0

    def start(self, tag: str, attributes: list[tuple[str, str]]) -> None:
        if tag in BLOCK:
            self.flush()
            if self.counts.get("p") and tag != "html":
                self.end("p")
        for other in CLOSED_BY_SAME.get(tag, ()):
            self._close(other, SCOPES)
        if tag in VOID:
            if tag in ("br", "hr", "img", "input"):
                self.texts.append(" ")
            return
        around = self.open[-1]
        own, named, hidden = _evidence(tag, attributes, around)
        hidden = around.hidden or hidden or tag in EMBEDDED or tag in ("head", "script", "style")
        self.elements += 1
        element = _Element(
            tag,
            self.elements,
            around,
            own,
            named,
            around.article or tag in ("article", "main"),
            hidden,
            around.link or tag == "a",
            *((self.elements, around.box) if tag in BLOCK else (around.box, around.outer)),
        )
        element.frame = element if tag in BLOCK and tag not in PARTS else around.frame or around
        if tag in ("article", "main") and not hidden:
            self.has_article, up = True, around
            while up is not None and not up.holds_article:
                up.holds_article, up = True, up.around
        self.open.append(element)
        self.every.append(element)
        self.counts[tag] = self.counts.get(tag, 0) + 1

    def weigh(self) -> None:
        """Adds up the evidence of each block: all elements around it, and the density of its container."""
        for block in self.blocks:
            free, up = len(block.text) - block.linked, block.element
            up.frame = up.frame or up
            up.frame.parts += free
            up.unlinked += free
        for element in reversed(self.every):  # an element stands behind the one around it
            element.around.unlinked += element.unlinked
        everything = self.open[0].unlinked
        # what stands in a footer, a menu or the like is not the richest container
        richest = max((b.element.frame.parts for b in self.blocks if self._total(b.element, everything) > -STRONG / 2), default=0)
        for block in self.blocks:
            block.evidence = self._total(block.element, everything)
            if not self.has_article and richest:
                block.evidence += DENSITY * min(block.element.frame.parts / richest, 1.0)

    def _total(self, element: _Element, everything: int) -> float:
        chain = []
        while element is not None and element.total is None:
            chain.append(element)
            element = element.around
        total = element.total if element is not None else 0.0
        for e in reversed(chain):
            frame = e.holds_article if self.has_article else e.unlinked > MOST * everything
            total += e.own + (max(e.named, 0.0) if frame else e.named)
            e.total = total
        return total

    def end(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        if self.counts.get(tag):
            while True:
                gone = self.open.pop()
                self.counts[gone.tag] -= 1
                if gone.tag == tag:
                    return

    def _close(self, tag: str, scopes: frozenset[str]) -> None:
        """Ends an open element that the next one ends, unless a new list or table stands between."""
        if self.counts.get(tag):
            for e in reversed(self.open):
                if e.tag == tag:
                    return self.end(tag)
                if e.tag in scopes:
                    return None
        return None


def _evidence(tag: str, attributes: list[tuple[str, str]], around: _Element) -> tuple[float, float, bool]:
    """What an element, and what its class and id add to the evidence of the text in it; whether it hides it."""
    own, named, hidden = 0.0, 0.0, False
    if tag in BOILERPLATE_ELEMENTS:
        own -= 1.0 if tag == "header" and around.article else STRONG
    elif tag in ("article", "main"):
        own += CONTENT
    elif around.article and tag in TEXT_PARTS:
        own += 1.0
    for name, value in attributes:
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and _HIDDEN.search(value)):
            hidden = True
        elif name == "role":
            own += CONTENT if value in ("main", "article") else -STRONG if value in BOILERPLATE_ROLES else 0.0
        elif name == "class" or (name == "id" and tag not in TEXT_PARTS):  # ids of headings and paragraphs are their text
            if tag not in ("html", "body"):
                words = _names(value)
                if words & BOILERPLATE_WORDS:
                    named -= STRONG
                elif words & CONTENT_WORDS:
                    named += CONTENT / 2
    return own, named, hidden


def _names(value: str) -> set[str]:
    """The words of class names, without those that say what the element has or which state it is in."""
    words: set[str] = set()
    for name in value.split():
        parts = _NAMES.findall(name)
        if not STATE_WORDS.intersection(parts):
            words.update(parts)
    return words


def _attributes(page: str, at: int) -> tuple[list[tuple[str, str]], int]:
    """Names and values, lower-cased, of a tag whose name ends at ``at``, and where the tag ends."""
    found = []
    while match := _ATTRIBUTE.match(page, at):
        at = match.end()
        if match[1]:
            return found, at
        found.append((match[2].lower(), (match[3] or match[4] or match[5] or "").lower()))
    return found, len(page)


def blocks_of(page: str) -> list[Block]:
    """Blocks of text in page order."""
    state, at, lowered, last_end = _Page(), 0, None, {}
    for match in iter(lambda: _TAG.search(page, at), None):
        state.text(page[at : match.start()])
        at = max(match.end(), at + 1)
        tag = match[2]
        if not tag:
            continue
        tag = tag.lower()
        if page.startswith(">", at):
            attributes, at = [], at + 1
        else:
            attributes, at = _attributes(page, at)
        if match[1]:
            state.end(tag)
            continue
        if tag in RAW:
            if tag in ("title", "textarea"):
                state.texts.append(" ")
            lowered = page.lower() if lowered is None and page.isascii() else lowered
            end = lowered.find(f"</{tag}", at) if lowered is not None else _find(page, tag, at)
            at = len(page) if end < 0 else page.find(">", end) + 1 or len(page)
        elif tag in EMBEDDED:
            state.texts.append(" ")
            if tag not in last_end:
                ends = list(re.finditer(f"</{tag}", page, re.I))
                last_end[tag] = ends[-1].start() if ends else -1
            if last_end[tag] >= at and not page.endswith("/>", 0, at):
                state.start(tag, attributes)
        else:
            state.start(tag, attributes)
    state.text(page[at:])
    state.flush()
    state.weigh()
    return state.blocks


def _find(page: str, tag: str, at: int) -> int:
    """Where the end tag starts, in any case; lower-casing could move positions in such a page."""
    found = re.compile(f"</{tag}", re.I).search(page, at)
    return found.start() if found else -1


def evidence_of(block: Block) -> float:
    """Log-odds that a block is content."""
    n = len(block.text)
    return block.evidence + LENGTH * (math.log2(n + 1) - 6) - LINKS * (block.linked / n if n else 0)


def min_cut(terminal: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Nodes on the source side of a minimum cut.

    ``terminal``: capacity from the source (positive) or to the sink (negative) of each node;
    ``edges``: node, node, capacity in both directions. Flow goes along shortest paths, a level
    graph at a time.
    """
    excess, near = list(terminal), [[] for _ in terminal]
    to, room = [], []
    for a, b, c in edges:
        for x, y in ((a, b), (b, a)):
            near[x].append(len(to))
            to.append(y)
            room.append(c)
    tiny = 1e-9
    while True:
        level = [0 if x > tiny else -1 for x in excess]
        queue, reached = [i for i, x in enumerate(excess) if x > tiny], False
        for node in queue:
            if excess[node] < -tiny:
                reached = True
                continue
            for e in near[node]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[node] + 1
                    queue.append(to[e])
        if not reached:
            return [x >= 0 for x in level]
        left = [iter(x) for x in near]
        for source in [i for i, x in enumerate(excess) if x > tiny]:
            path: list[int] = []
            node = source
            while excess[source] > tiny:
                if excess[node] < -tiny:
                    flow = min([excess[source], -excess[node], *(room[e] for e in path)])
                    excess[source] -= flow
                    excess[node] += flow
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    node, path = source, []
                    left[source] = iter(near[source])
                    continue
                step = next((e for e in left[node] if room[e] > tiny and level[to[e]] == level[node] + 1), None)
                if step is not None:
                    path.append(step)
                    node = to[step]
                elif path:
                    level[node] = -1  # leads nowhere in this level graph
                    node = to[path.pop() ^ 1]
                    left[node] = iter(near[node])
                else:
                    break


def content_of(blocks: list[Block]) -> list[bool]:
    """Whether each block is content: the source side of the minimum cut."""
    terminal = [evidence_of(b) for b in blocks]
    edges = [(i - 1, i, NEIGHBOURS) for i in range(1, len(blocks))]
    nodes: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if block.container not in nodes:
            nodes[block.container] = len(terminal)
            terminal.append(0.0)
        edges.append((i, nodes[block.container], SAME_CONTAINER))
    return min_cut(terminal, edges)[: len(blocks)]


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    return "\n".join(b.text for b, keep in zip(blocks, content_of(blocks), strict=True) if keep)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column("html")]
        lengths = pa.array(map(len, texts), pa.int64())
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), lengths]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row; no shuffle."""
    return pages.select("page_id", "url", "html").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
