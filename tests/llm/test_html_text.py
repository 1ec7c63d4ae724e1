"""Main text of pages against the parts that pages are put together from."""

from __future__ import annotations

import html
import re

import pytest

from candlewick.llm import html_text
from candlewick.llm.common import documents
from candlewick.llm.html_text import main_text
from candlewick.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"
LONG = "A first sentence of the story, with some words. And a second one, which is a bit longer than that; it ends here."


def plain(page: str) -> str:
    """The text between the article's tags."""
    inner = re.search("<article>(.*)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", inner))).split())


def test_query_gives_articles_of_whole_table(spark):
    pages = {r.page_id: r for r in documents(spark, SMALL, "pages").collect()}
    got = QUERIES["op13_html_text"](spark, SMALL).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        want = plain(pages[r.page_id].html)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))


PARTS = {
    "menu": "<nav><ul><li><a href=/a>Home page</a><li><a href=/b>All of the news, and more</a></ul></nav>",
    "menu without a tag of its own": "<div><ul><li><a href=/a>Home</a></li><li><a href=/b>News, sport. More</a></li></ul></div>",
    "header": "<header><h1>The Daily Site, of all things</h1><p>News since the year 1900, and longer.</p></header>",
    "footer": "<footer><p>All rights are reserved by us, and nobody else. Do ask, please, before use.</p></footer>",
    "sidebar": "<aside><h3>Read next</h3><p>Another story, that is quite long, and has its own sentences. Two of them.</p></aside>",
    "sidebar by class": '<div class="left-sidebar"><p>Another story, that is quite long, and has its own sentences.</p></div>',
    "notice": '<div id="cookieNotice" role="alert">We use cookies, as all others do. Please accept them, or leave.</div>',
    "advert": '<div class="ad">Buy now, pay later. It is cheap, good, and here.</div>',
    "form": "<form action=/s><label>Your mail address, please:</label><input name=q><button>Send it, now</button></form>",
    "script": '<script>if (a < b) { document.write("<p>Some text, in code.</p>"); }</script>',
    "style": "<style>p > b { content: '<p>Text, in style.</p>' }</style>",
    "comments": '<section class="comments"><h3>Comments</h3><article class="comment"><p>I like it a lot, so much. Really, I do!</p></article></section>',
    "markup comment": "<!-- <p>Old text, taken out. It was long, and dull.</p> -->",
    "hidden": '<div style="display: none"><p>Some text, that no one sees. It is here, though.</p></div>',
}


@pytest.mark.parametrize("part", PARTS)
@pytest.mark.parametrize("container", ["<article>{}</article>", "<main><div class=post-content>{}</div></main>", "<div><div>{}</div></div>"])
def test_parts_around_the_article_are_left_out(part, container):
    story = f"<h1>A title of it</h1><p>{LONG}<p>{LONG} <b>Bold</b>ly so.</p><ul><li>One point, that is made.</li></ul>"
    page = f"<!DOCTYPE html><html><head><title>A title</title></head><body>{PARTS[part]}{container.format(story)}{PARTS[part]}</body></html>"
    assert main_text(page) == f"A title of it {LONG} {LONG} Boldly so. One point, that is made."


def test_short_article_beside_long_advert():
    page = f'<body><div class="ad">{LONG}</div><article><h1>Hi.</h1><p>Yes.</p></article><footer>{LONG}</footer>'
    assert main_text(page) == "Hi. Yes."


def test_characters_blocks_and_white_space():
    page = "<article><p>a&nbsp;&amp;\n b&#x41;&copy &lt;i&gt; 1 < 2<br>c</p>d<table><tr><td>e<td>f</table><pre>g\n  h</pre></article>"
    assert main_text(page) == "a & bA© <i> 1 < 2 c d e f g h"


def test_broken_markup():
    assert main_text("<article><p>One, two.<div>Three</b>, four.</p></div></article><footer>no") == "One, two. Three, four."
    assert main_text(f"<body><article><p>{LONG}<a href='x") == LONG
    assert main_text("<article><p>Kept.</p><script>lost") == "Kept."
    assert main_text('<article><p class="a>One</p><p>Two, three.</p></article>')  # quote left open
    assert main_text(f"<body><form><div><p>{LONG}</p></div><select><option>no</select></form>") == LONG


def test_odd_rows(spark):
    many = "<p>word, </p>" * 50_000
    rows = [(1, "u", None), (None, None, ""), (2, "u", "<p></p><!-- -->"), (2, "u", "no tags, only text."), (2, "u", "no tags, only text."), (3, "u", many)]
    pages = spark.createDataFrame([(*r, "old", "old") for r in rows], "page_id long, url string, html string, text string, n_chars string")
    got = html_text.extracted(pages)
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    found = sorted((r.page_id or 0, r.text[:20], r.n_chars) for r in got.collect())
    plain_text = (2, "no tags, only text.", 19)
    assert found == [(0, "", 0), (1, "", 0), (2, "", 0), plain_text, plain_text, (3, "word, word, word, wo"[:20], 6 * 50_000 - 1)]
    assert html_text.extracted(pages.limit(0)).count() == 0
