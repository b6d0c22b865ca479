"""Main text of pages."""

import html
import re

import pytest

from demandspark.llm.op6_html import extract, main_text
from demandspark.llm.registry import QUERIES


def by_pattern(page):
    """For the test tables, whose articles hold headings, paragraphs and line breaks only."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = [html.unescape(re.sub(r"<[^>]*>", " ", b)) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(" ".join(b.split()) for b in blocks if b.split())


def test_query(spark, folder):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = QUERIES["op6_html"][0](spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == by_pattern(pages[r.page_id]) and r.n_chars == len(r.text)


LONG = "Plain words of the story go on and on, as stories do, without a link. " * 4


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""), ("", ""), ("<p>", ""), ("just text &amp; more", "just text & more"),
        (f"<header><h1>Site</h1></header><div class='content'><h1>T</h1><p>{LONG}<p>{LONG}</div><aside>x</aside>",
         "\n".join(["T", LONG.strip(), LONG.strip()])),
        (f"<main><article><p>{LONG}</p><ul><li>a<li>b</ul><div class='comments'><p>{LONG}</p></div></article></main>",
         "\n".join([LONG.strip(), "a", "b"])),
        (f"<div id=cookie-notice>{LONG}</div><article><p>a  <b>b</b>\n c<br>d</p><p>{LONG}<form>x</form></article><footer>{LONG}",
         "\n".join(["a b c d", LONG.strip()])),
        (f"<article><p>1 < 2 &lt; 3 {LONG}</p><!-- <p>no</p> --><script>if (a</p>b) </script><p>end</article",
         f"1 < 2 < 3 {LONG}".strip() + "\nend</article"),
        (f"<table><tr><td>{LONG}<td>two<tr><td>three</table>", "\n".join([LONG.strip(), "two", "three"])),
    ],
)
def test_pages(page, text):
    assert main_text(page) == text


def test_hard_pages(spark):
    deep, wide = "<div>" * 20_000 + "x" + "</div>" * 20_000, "<a b='" * 5000
    pages = [(1, "u", deep), (2, None, wide), (None, "u", None), (4, "u", "<p>" + "word " * 200_000), (4, "u", "<p>twice"), (4, "u", "<p>twice")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = extract(frame).collect()
    assert len(got) == 6 and got[0].text == "x" and got[2].text == "" and got[3].n_chars == 999_999
    assert extract(frame.where("false")).count() == 0


STORY = "".join(f"<p>{LONG}</p>" for _ in range(6))


@pytest.mark.parametrize("around", [
    "div class='content has-sidebar'", "div id='page' class='header-fixed'", "div class='no-comments'", "div class='social-sciences'",
    "form id='aspnetForm'", "div class='sidebar'", "div class='wrap footer-sticky nav-open'",
])
@pytest.mark.parametrize("element", ["div", "article"])
def test_wrappers_of_the_whole_page_stay(around, element):
    if around == "div class='sidebar'" and element == "div":
        return  # nothing tells that it isn't one
    page = (f"<body><{around}><{element}>{STORY}</{element}><ul class='nav-links'><li>Menu</ul><div class='comment-list'>"
            f"{STORY}{STORY}</div><div class='cookie-notice'>We use cookies</div></{around.split()[0]}></body>")
    assert main_text(page) == "\n".join([LONG.strip()] * 6)


def test_readers_articles_are_no_articles():
    page = f"<article>{STORY}</article><ol class='comments'><li><article class='comment'>{STORY}{STORY}</article></ol>"
    assert main_text(page) == "\n".join([LONG.strip()] * 6)
