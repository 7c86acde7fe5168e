"""Main text of pages: the cut against all labellings, hand-made pages, malformed markup and odd rows."""

import itertools
import random
import re
import time
from html import unescape

import pyarrow.parquet as pq
import pytest

from quayside.llm import pages
from quayside.llm.common import ship
from quayside.llm.cut import Network

PROSE = "The harbour was rebuilt after the storm of that year, and the quay walls were raised by two feet. Ships came back in spring."
PAGE = f"""<!DOCTYPE html><html><head><meta charset=utf-8><title>Harbour</title><style>p{{x}}</style><script>var t="</p><p>no";</script></head>
<body class="home has-sidebar"><div id="cookie-notice"><p>We use cookies to improve this site. {PROSE}</p><button>Accept</button></div>
<header class="site-header"><a href="/">Harbour News</a><form action=/s><label>Search</label><input name=q></form></header>
<ul class="menu"><li><a href="/1">Home</a><li><a href="/2">World</a><li><a href="/3">Sport</a></ul>
<div class="wrapper with-sidebar"><article class="post"><header><h1>A new quay</h1></header><p>{PROSE}<p>Short.
<p>Fish &amp; chips&nbsp;cost &pound;4 &lt;today&gt;.<div class="ad-slot">Buy boats now. {PROSE}</div><h2>Costs</h2><ul><li>stone</li><li>timber and <a href=/t>tar</a></li></ul>
<table><tr><td>1<td>2<tr><td>3</table><p style="display:none">hidden</p><aside class="related"><p>{PROSE}</p></aside><p>The end.</p><footer>Filed under Ports</footer></article>
<section id="comments"><h3>Comments</h3><article class="comment"><p>{PROSE} I disagree with the writer.</p></article></section>
<div class="sidebar"><h3>Popular</h3><p>{PROSE}</p></div></div><footer>&copy; 2020 Harbour News. All rights reserved.</footer></body></html>"""


def test_hand_made_page():
    want = ["A new quay", PROSE, "Short.", "Fish & chips cost £4 <today>.", "Costs", "stone", "timber and tar", "1", "2", "3", "The end."]
    assert pages.main_blocks(PAGE)[0] == want


def test_page_without_semantic_tags():
    """Plain boxes: long text is found by words and sentences, a short paragraph stays with its neighbours, links go."""
    menu = "".join(f"<div><a href=/{k}>Link number {k}</a></div>" for k in range(12))
    body = f"<div><h1>Quay</h1><p>{PROSE}</p><p>Yes.</p><p>{PROSE}</p></div>"
    page = f"<html><body><div>{menu}</div>{body}<div>{menu}</div><div>Copyright 2020 Harbour</div></body></html>"
    assert pages.main_blocks(page)[0] == ["Quay", PROSE, "Yes.", PROSE]
    assert pages.main_blocks(f"<body><nav>{menu}</nav></body>")[0] == []


def test_given_pages():
    for raw in pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist():
        article = re.search("<article>(.*?)</article>", raw, re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert pages.main_blocks(raw)[0] == [b for b in blocks if b]


def energy(gains, joins, side):
    return sum(g if g > 0 and not s else -g if g < 0 and s else 0 for g, s in zip(gains, side, strict=True)) + sum(c for a, b, c in joins if side[a] != side[b])


def test_cut_is_minimal():
    rnd = random.Random(2)
    for _ in range(300):
        n = rnd.randint(1, 9)
        gains = [rnd.randint(-6, 6) for _ in range(n)]
        joins = [(*rnd.sample(range(n), 2), rnd.randint(0, 5)) for _ in range(rnd.randint(0, 14))] if n > 1 else []
        net = Network(n)
        for k, g in enumerate(gains):
            net.terminal(k, g)
        for a, b, c in joins:
            net.join(a, b, c)
        side = net.source_side()
        every = [(energy(gains, joins, s), sum(s), list(s)) for s in itertools.product((False, True), repeat=n)]
        assert (energy(gains, joins, side), side) == (min(every)[0], min(every)[2])


def test_labels_of_pages_are_minimal():
    """Small random pages: the kept blocks are those of the cheapest of all labellings of blocks and elements."""
    rnd, costs = random.Random(3), pages.Costs()
    for _ in range(60):
        parts = []
        for _ in range(rnd.randint(1, 3)):
            tag = rnd.choice(["div", "nav", "article", "section", 'div class="ad"'])
            inner = "".join(rnd.choice([f"<p>{PROSE}</p>", "<p>Of.</p>", "<a href=x>link</a>", "some words"]) for _ in range(rnd.randint(1, 2)))
            parts.append(f"<{tag}>{inner}</{tag.split()[0]}>")
        page = pages.Page("".join(parts))
        n, m = len(page.blocks), len(page.elements)
        if n + m > 13:
            continue
        gains = [pages.gain(b, page, costs) for b in page.blocks] + [0] * m
        states = [e.state for e in page.elements]
        joins = [(k, n + b.element, costs.parent) for k, b in enumerate(page.blocks)]
        joins += [(k - 1, k, costs.neighbour if states[page.blocks[k - 1].element] == states[page.blocks[k].element] else costs.edge) for k in range(1, n)]
        joins += [(n + k, n + page.elements[k].parent, costs.parent if states[k] == states[page.elements[k].parent] else costs.edge) for k in range(1, m)]
        best = min((energy(gains, joins, s), sum(s), s) for s in itertools.product((False, True), repeat=n + m))
        assert pages.main_blocks("".join(parts))[0] == [b.text for b, kept in zip(page.blocks, best[2], strict=False) if kept]


@pytest.mark.parametrize(
    "raw",
    ["", "<", "<<<>>>", "</", "<!--", "<!-- x <p>y", "<p", "<p class='", "<script>", "<title>", "a < b & c > d &amp", "<ä>", "<a" * 3000, "<div>" * 3000, "</p>" * 3000,
     "<p x=\"" * 3000, "<title>" * 3000, "<!--" * 3000, "&#xD800;&#0;&bogus;", "<p><table><p></td></div>x", "<svg/><p>x", "\x00<p\x00>"],
)
def test_malformed(raw):
    started = time.time()
    for text in (raw, raw + f"<article><p>{PROSE}</p></article>", f"<article><p>{PROSE}</p>" + raw):
        for block in pages.main_blocks(text)[0]:
            block.encode()
    assert time.time() - started < 5


def test_long_page():
    started = time.time()
    body = "".join(f"<p>{PROSE} {k}</p><p>Of.</p><div class=ad>ad</div>" for k in range(4000))
    got = pages.main_blocks(f"<body><nav><a href=x>y</a></nav><div>{body}</div></body>")[0]
    assert len(got) == 8000 and time.time() - started < 30


def test_odd_rows(spark):
    ship(spark)
    rows = [(1, "u", PAGE, "x", 1), (1, "u", PAGE, "x", 1), (None, None, f"<main>{PROSE}</main>", "x", 1), (2, "v", None, "x", 1), (3, "w", "", "x", 1), (4, None, "<nav>a</nav>", None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = sorted((tuple(r)[:4] for r in pages.extract_text(df).collect()), key=str)
    text = "\n".join(pages.main_blocks(PAGE)[0])
    want = [(1, "u", text, len(text))] * 2 + [(2, "v", "", 0), (3, "w", "", 0), (4, None, "", 0), (None, None, PROSE, len(PROSE))]
    assert got == sorted(want, key=str)
    assert pages.extract_text(df.limit(0)).collect() == []
