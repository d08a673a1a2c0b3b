"""Main texts of pages with and without an article element, of odd markup, and of the driver's pages."""

from __future__ import annotations

import re
import time
from html import unescape

import pytest
from pyspark.sql import functions as F

from shelfspark.llm import html
from shelfspark.llm.html import main_text
from tests.conftest import SF

LONG = "This sentence of the story is long enough to count as a part of the main text of its page."


def test_whole_articles_of_the_pages(spark):
    """Headings, paragraphs and the shortest blocks, in order; nothing else of the page."""
    pages = {r.page_id: r for r in html.extract(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (" ".join(unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split("</?(?:p|h1)>", article))
        assert pages[r.page_id].text == "\n".join(b for b in blocks if b)
        assert pages[r.page_id].n_chars == len(pages[r.page_id].text) and pages[r.page_id].url == r.url


BOILERPLATE = [
    "<header><h1>The Site</h1><p>{0}</p></header>", "<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>", "<aside><p>{0}</p></aside>", "<footer><p>{0}</p></footer>",
    "<form><p>{0}</p><label>Name <input></label><button>Send</button></form>", "<div class='cookie-notice'><p>{0}</p></div>", '<div id="sidebar"><p>{0}</p><p>{0}</p></div>',
    "<section class=comments><h2>Comments</h2><article class=comment><p>{0}</p></article></section>", "<div role=banner>{0}</div>", "<script>var x = '<p>{0}</p>';</script>",
    "<style>p {{ content: '{0}' }}</style>", "<noscript><p>{0}</p></noscript>", "<!-- <p>{0}</p> -->", "<div class='AdSlot adBox'><p>{0}</p></div>", "<div class=related><article><p>{0}</p></article></div>",
]


@pytest.mark.parametrize("frame", ["<article>{0}</article>", "<main>{0}</main>", "<div class='content with-sidebar'><article>{0}</article></div>", "<div>{0}</div>"])
def test_boilerplate_before_amid_and_after(frame):
    """A page is the same with and without any piece of boilerplate, wherever it stands."""
    parts = ["<h1>Title</h1>", f"<p>{LONG}</p>", "<p>Short.</p>", f"<p>{LONG} <b>2</b></p>", f"<ul><li>{LONG}</li><li>Item.</li></ul>"]
    want = "\n".join(["Title", LONG, "Short.", f"{LONG} 2", LONG, "Item."])
    assert main_text(f"<html><body>{frame.format(''.join(parts))}</body></html>") == want
    for piece in BOILERPLATE:
        other = piece.format("An intruding text that is as long as any other sentence of this page, so that length alone does not tell.")
        for at in range(len(parts) + 1):
            if piece.startswith("<header") and frame != "<div>{0}</div>":
                continue  # headings in an article's own header stay
            inside = "".join([*parts[:at], other, *parts[at:]])
            assert main_text(f"<html><body>{frame.format(inside)}</body></html>") == want, (piece, at)
        assert main_text(f"<html><body>{other}{frame.format(''.join(parts))}{other}</body></html>") == want, piece


def test_stretches_surge_and_dive():
    assert html.stretches([0, 5, 0, 90, 80, 0, 0, 0, 0, 3, 0], 80) == [(1, 5)]
    assert html.stretches([0, 0, 0, 0], 1) == []
    assert html.stretches([1], 1) == [(0, 1)]


def test_link_lists_are_no_main_text():
    menu = "".join(f"<div><a href=/{i}>A long link text that could be a headline of some other page</a></div>" for i in range(9))
    assert main_text(f"<body><div>{menu}</div><div><p>{LONG}</p><p>{LONG}</p></div><div>{menu}</div></body>") == f"{LONG}\n{LONG}"
    assert main_text(f"<body><div>{menu}</div></body>") == ""


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), (" \n", ""), ("plain", "plain"), ("a < b &amp; c", "a < b & c"), ("<p>x<p y='>z</p> q", "x\nz\nq"), ("<p>cut off &am", "cut off &am"), ("<p>tail <b", "tail"),
    ("<p>a&#233;&eacute;&nbsp;&lt;b&gt;</p>", "aéé <b>"), ("<P>Up</P><DIV>per</DIV>", "Up\nper"), ("<p>one<br>two</p>", "one two"), ("<p>a<b>b</b>c</p>", "abc"), ("</div></p>text", "text"),
    ("<article><header><h1>T</h1><p>by me</p></header><p>x</p></article>", "T\nx"), ("<title>t</title><p>b</p>", "b"), ("<p>日本語 テキスト</p>", "日本語 テキスト"), ("<script>never ends", ""),
])
def test_odd_markup(page, text):
    assert main_text(page) == text


def test_no_nesting_is_slow():
    k = 100_000
    for page in ("<div>" * k + "</ul>" * k, "<a href='" * k, '<p x="' * k, "<div class=ad>" * k + "</div>" * k, "<article>" * k, "<" * k, "<!--" * k, f"<p>{LONG}</p>" * k):
        began = time.time()
        main_text(page)
        assert time.time() - began < 20


def test_tables(spark):
    rows = [(1, "u", "<p>x</p>"), (1, "u", "<p>x</p>"), (None, None, None), (2, None, ""), (3, "v", "<p>" + "word " * 100_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("user's") for c in ("text", "n_chars", "line")})
    out = sorted(((r.page_id, r.url, r.text[:4], r.n_chars) for r in html.extract(df).collect()), key=str)
    assert out == sorted([(1, "u", "x", 1), (1, "u", "x", 1), (None, None, "", 0), (2, None, "", 0), (3, "v", "word", 499_999)], key=str)
    assert html.extract(df.limit(0)).collect() == []
