"""Main text of web pages by a minimum cut.

A page becomes blocks of text in a tree of elements. A linear classifier scores each block: words, links, sentence ends,
tag, and what its containers say they are (``HINTS``). Score and sign become the block's terminal capacity; neighbours in
reading order, and elements with their parents, are joined by smoothness edges, which are weak where a container begins
that says what it is. The maximum flow parts content from the rest, so that a short paragraph stays with the article
around it and a long one does not pull its sidebar along.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import as_text, query, ship, table, text_slices
from quayside.llm.cut import Network

#: Elements whose content is never text of the page; the first row is read up to its end tag whatever it holds.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = RAW | frozenset("noscript template svg math object select button datalist audio video canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end the block before and after them.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody "
    "td tfoot th thead tr ul".split()
)
#: Marks of letters and words: they neither end a block nor hold one.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small strike strong sub sup tt u var wbr".split())
#: What a new element ends if it is still open: cells and rows end with the next cell or row, items with the next item.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("td", "th", "tr"),
    "td": ("td", "th"), "th": ("td", "th"), "tbody": ("td", "th", "tr", "thead", "tbody"),
}
#: Elements within which such an end is looked for.
SCOPES = frozenset("ul ol dl table select menu".split())

#: Words of class, id and role that tell what a container is.
BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "notices notification alert paywall subscribe subscription newsletter signup share sharing social related recommended "
    "recommendations trending popular teaser teasers comment comments commentlist reply replies respond disqus discussion "
    "sidebar aside rail menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer bottom copyright legal "
    "disclaimer popup modal overlay dialog widget widgets toolbar masthead login search searchform form complementary "
    "contentinfo tags skip outbrain taboola".split()
)
HEAD_WORDS = frozenset("header head topbar masthead banner".split())
FRAME_WORDS = frozenset("layout wrapper wrap page site container grid row outer".split())
#: Beginnings of class names that tell what a container has, not what it is.
_HAS = re.compile(r"(?:has|with|no|without|is|js)[-_]", re.I)
GOOD_WORDS = frozenset("article articlebody main content maincontent post postbody entry story body text prose hentry".split())
BAD_TAGS = frozenset("nav footer aside form menu dialog search fieldset".split())
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: Phrases that open notices; they count in short blocks only.
NOTICES = re.compile(
    r"\s*(©|\(c\)|copyright\b|all rights reserved|advertisement\b|sponsored\b|we use cookies|this (web)?site uses cookies|accept (all )?cookies"
    r"|subscribe\b|sign up\b|share (this|on)\b|follow us\b|related (articles|posts|stories)|read more\b|leave a (comment|reply)|skip to )",
    re.I,
)

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_TAG_REST = re.compile(r"(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SENTENCE = re.compile(r"[.!?…。！？][\"'”’)\]]*(?:\s|$)")


@dataclass(frozen=True)
class Costs:
    """Weights of the classifier and of the smoothness edges, in hundredths of a nat."""

    main: int = 260  # inside an element that says it is the main text
    bad_tag: int = -420  # inside nav, footer, aside, a header of the page, a form
    bad_word: int = -380  # inside an element whose class, id or role says it is no content
    words: int = 6  # for each word, up to ``most_words``
    most_words: int = 40
    sentence: int = 25  # for each sentence end, up to three
    links: int = -260  # times the share of linked characters
    short: int = -50  # fewer than ten words without a sentence end
    heading: int = 60
    item: int = -30
    notice: int = -200
    base: int = -20
    neighbour: int = 60  # blocks that follow each other
    parent: int = 90  # an element and its parent
    edge: int = 8  # either of these, where a container begins that says what it is


@dataclass
class Element:
    tag: str
    parent: int
    hint: int  # what it says of itself: 1 main text, 2 surely main, -1 not by a word, -2 not by a tag, -3 head or frame, 0 nothing
    holds_main: bool = False
    state: int = 0  # what holds for its content: 1, 0, -1, -2


@dataclass
class Block:
    element: int
    tag: str
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def hint(tag: str, attributes: dict[str, str]) -> int:
    if tag in ("html", "body"):
        return 0
    role = attributes.get("role", "").lower()
    if tag == "main" or role == "main" or attributes.get("itemprop", "").lower() == "articlebody":
        return 2
    if tag in BAD_TAGS or role in ("navigation", "complementary", "contentinfo", "search", "form", "alert", "dialog", "alertdialog"):
        return -2
    if tag == "header" or role == "banner":
        return -3
    names = [n for n in f"{attributes.get('class', '')} {attributes.get('id', '')}".split() if not _HAS.match(n)]
    words = {w.lower() for n in names for w in _WORDS.findall(n)} | {n.lower() for n in names}
    if words & BAD_WORDS:
        return -3 if words & (HEAD_WORDS | FRAME_WORDS) else -1
    if words & HEAD_WORDS:
        return 0 if words & GOOD_WORDS else -3
    return 1 if tag == "article" or words & GOOD_WORDS else 0


class Page:
    """Blocks and elements of one page, read once from left to right whatever is malformed."""

    def __init__(self, source: str) -> None:
        self.elements = [Element("", -1, 0)]
        self.blocks: list[Block] = []
        self.open: list[int] = [0]
        self.count: dict[str, int] = {}
        self.hidden = 0  # open elements at the first hidden one, or 0
        self.in_link = False
        self.block: Block | None = None
        self._read(source)
        self._flush()
        for at, e in enumerate(self.elements):
            if at:
                e.state = self._state(e)

    def _state(self, e: Element) -> int:
        above = self.elements[e.parent].state
        if e.hint == 2:
            return 1
        if e.hint in (-1, -2, -3) and not e.holds_main:
            if e.hint == -3:
                return above if above else -2
            return min(above, e.hint) if above < 0 else e.hint
        if e.hint == 1 and above >= 0:
            return 1
        return above

    def _read(self, source: str) -> None:
        at, end, quotes, comments = 0, len(source), True, True
        unended: set[str] = set()
        while at < end:
            less = source.find("<", at)
            if less < 0:
                less = end
            if less > at:
                self._text(source[at:less])
            if less >= end:
                return
            after = source[less + 1 : less + 2]
            if after.isascii() and after.isalpha() or (after == "/" and source[less + 2 : less + 3].isalpha()):
                closing = after == "/"
                name = _NAME.match(source, less + 1 + closing)
                if name is None:  # a letter beyond ASCII
                    self._text(source[less : less + 1])
                    at = less + 1
                    continue
                rest = _TAG_REST.match(source, name.end()) if quotes else None
                if rest is None:  # a quote or the tag is never ended: take tags up to the next > from here on
                    quotes = False
                    stop = source.find(">", name.end())
                    stop = end if stop < 0 else stop + 1
                else:
                    stop = rest.end()
                tag = name[0].lower()
                at = stop
                if closing:
                    self._close(tag)
                else:
                    self._open(tag, source[name.end() : stop])
                    if tag in RAW:
                        found = None if tag in unended else re.compile(f"</{tag}(?=[\\s/>])", re.I).search(source, stop)
                        if found is not None:
                            at = found.start()
                        elif tag in ("script", "style"):
                            return
                        else:
                            unended.add(tag)
                            self._close(tag)
            elif source.startswith("<!--", less):
                stop = source.find("-->", less + 2) if comments else -1
                if stop < 0:
                    comments = False
                    stop = source.find(">", less)
                    at = end if stop < 0 else stop + 1
                else:
                    at = stop + 3
            elif after in ("!", "?", "/"):
                stop = source.find(">", less)
                at = end if stop < 0 else stop + 1
            else:
                self._text("<")
                at = less + 1

    def _text(self, raw: str) -> None:
        if self.hidden:
            return
        if self.block is None:
            if raw.isspace():
                return
            e = self.open[-1]
            self.block = Block(e, self.elements[e].tag)
        text = html.unescape(raw) if "&" in raw else raw
        self.block.parts.append(text)
        if self.in_link:
            self.block.linked += len(text)

    def _flush(self) -> None:
        if self.block is not None:
            self.block.text = " ".join("".join(self.block.parts).split())
            if self.block.text:
                self.blocks.append(self.block)
            self.block = None

    def _open(self, tag: str, rest: str) -> None:
        if tag == "br":
            self._text(" ")
        if tag in BLOCKS:
            self._flush()
            if self.count.get("p"):
                self._close_to("p")
            for name in ENDS.get(tag, ()):
                if self.count.get(name):
                    self._close_to(name, SCOPES)
        elif tag == "a":
            self.in_link = "href" in rest
        if tag in INLINE or tag in VOID or rest.endswith("/>") and tag not in BLOCKS and tag not in DROPPED:
            return
        attributes = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(rest)} if len(rest) > 1 else {}
        out = tag in DROPPED or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"
        out = out or bool(_HIDDEN.search(attributes.get("style", "")))
        if out and not self.hidden:
            self.hidden = len(self.open)
        says = hint(tag, attributes)
        self.elements.append(Element(tag, self.open[-1], says))
        if says == 2 or tag == "article":
            up = self.open[-1]
            while up >= 0 and not self.elements[up].holds_main and (says == 2 or not self._lists(up)):
                self.elements[up].holds_main = True
                up = self.elements[up].parent
        self.open.append(len(self.elements) - 1)
        self.count[tag] = self.count.get(tag, 0) + 1

    def _lists(self, at: int) -> bool:
        """Whether articles in it may be comments or teasers; other containers are cleared by an article."""
        e = self.elements[at]
        return e.hint == -1 or e.tag in ("aside", "nav", "footer")

    def _close_to(self, tag: str, scope: frozenset[str] = frozenset()) -> None:
        """End everything up to the innermost open ``tag``, unless a ``scope`` element stands between."""
        for k in range(len(self.open) - 1, 0, -1):
            name = self.elements[self.open[k]].tag
            if name == tag:
                break
            if name in scope:
                return
        else:
            return
        for at in self.open[k:]:
            self.count[self.elements[at].tag] -= 1
        del self.open[k:]
        if self.hidden >= k:
            self.hidden = 0

    def _close(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
        if tag in BLOCKS:
            self._flush()
            self.in_link = self.in_link and tag not in ("nav", "ul", "div", "section")
        if self.count.get(tag) and tag not in ("html", "body"):
            self._close_to(tag)


def gain(block: Block, page: Page, costs: Costs) -> int:
    """What the classifier gives for content (above zero) or for the rest (below zero)."""
    state = page.elements[block.element].state
    words = block.text.count(" ") + 1
    ends = len(_SENTENCE.findall(block.text)) if words > 2 else 0
    out = costs.base + costs.words * min(words, costs.most_words) + costs.sentence * min(ends, 3)
    out += costs.links * min(block.linked, len(block.text)) // len(block.text)
    if words < 10 and not ends:
        out += costs.short
    if block.tag[:1] == "h" and block.tag[1:].isdigit():
        out += costs.heading
    if block.tag in ("li", "td", "th", "dd", "dt"):
        out += costs.item
    if words < 30 and NOTICES.match(block.text):
        out += costs.notice
    return out + {1: costs.main, 0: 0, -1: costs.bad_word, -2: costs.bad_tag}[state]


def network(page: Page, costs: Costs) -> Network:
    """Blocks first, then elements, as nodes."""
    n = len(page.blocks)
    net = Network(n + len(page.elements))
    states = [e.state for e in page.elements]
    for k, block in enumerate(page.blocks):
        net.terminal(k, gain(block, page, costs))
        net.join(k, n + block.element, costs.parent)
        if k:
            alike = states[page.blocks[k - 1].element] == states[block.element]
            net.join(k - 1, k, costs.neighbour if alike else costs.edge)
    for k, e in enumerate(page.elements):
        if k:
            net.join(n + k, n + e.parent, costs.parent if e.state == states[e.parent] else costs.edge)
    return net


def main_blocks(source: str, costs: Costs | None = None) -> tuple[list[str], int]:
    """Texts of the blocks of content in page order, and the number of all blocks."""
    page = Page(source)
    if not page.blocks:
        return [], 0
    side = network(page, costs or Costs()).source_side()
    return [b.text for b, kept in zip(page.blocks, side, strict=False) if kept], len(page.blocks)


def extract_text(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html", costs: Costs | None = None) -> DataFrame:
    """Per row of ``pages``: ``page_id``, ``url``, ``text``, ``n_chars`` (code points), ``n_blocks`` and ``n_kept``.

    A block's white space (references decoded, ``br`` counts) becomes single spaces; blocks are joined by one line feed.
    Null and empty pages and pages without main text give an empty text. Malformed markup is read as far as it goes: text
    in open elements counts, an unended script or style hides the rest. Pages are worked on whole, one at a time, in memory
    that grows with the longest one. Null keys stay, repeated rows give a row each, an empty table gives none; other columns
    are not read. ``key`` is an integer column.
    """
    ship(pages.sparkSession)
    three = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html"))
    costs = costs or Costs()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "html"):
            found = [main_blocks(raw, costs) for raw in as_text(batch.column("html"))]
            texts = ["\n".join(blocks) for blocks, _ in found]
            counts = ([len(t) for t in texts], [n for _, n in found], [len(b) for b, _ in found])
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), *(pa.array(c, pa.int64()) for c in counts)]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"])

    return three.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long")


@query("op11_min_cut_text")
def min_cut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))
