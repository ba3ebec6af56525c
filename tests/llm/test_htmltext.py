import html
import re

import numpy as np
import pytest

from stockweave.llm import htmltext
from stockweave.llm.catalog import QUERIES

PAGE = """<!DOCTYPE html><body><header class="site"><h1>Site</h1><nav><a href=x>a</a></nav></header>
<main><article><header><h1>Title &amp; x</h1></header><p>One <i>two</i>
three<ul><li>a<li>b</ul><pre>x  y</pre><aside>no</aside><div class="comments"><p>c</p></div>
<form>f<input></form><table><tr><td>q<td>r</table><script>var t="</p>";</script></article></main>
<div id=cookie-notice>ck</div><footer>f</footer>"""
PARAGRAPH = "Many words of text stand here, one after the other, without any markup at all. " * 4
PLAIN = (
    "<body>"
    + "".join(f"<div><a href={i}>item {i}</a> | <a>more</a></div>" for i in range(12))
    + f"<h1>Heading</h1><p>{PARAGRAPH}</p><p>Short.</p><p>{PARAGRAPH}</p>"
    + "".join(f"<div><a href={i}>link {i}</a></div>" for i in range(12))
)


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        ("just text", "just text"),
        (PAGE, "Title & x\n\nOne two three\n\na\n\nb\n\nx y\n\nq\n\nr"),
        (PLAIN, "\n\n".join(["Heading", PARAGRAPH.strip(), "Short.", PARAGRAPH.strip()])),
        ("<div class='layout has-sidebar'><p>kept</p></div>", "kept"),
        ("<article><p>a</b></p>b</i><div>c</article>d", "a\n\nb\n\nc"),
        ("<nav>x</nav><script>if (a</b) {}</script>", ""),
    ],
)
def test_pages(page, text):
    assert htmltext.main_text(page) == text


def test_smoothing_keeps_a_constant():
    assert np.allclose(htmltext.smooth(np.full(7, 3.0), 1.0), 3.0)


def test_long_page():
    page = "<article>" + f"<p>{PARAGRAPH}</p>" * 3000 + "</article>" + "<div>" * 3000
    assert htmltext.main_text(page) == "\n\n".join([PARAGRAPH.strip()] * 3000)


def test_rows(spark):
    rows = [(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (None, None, None, "t"), (2, "v", "", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(htmltext.extract(pages).collect(), key=str)
    text = htmltext.main_text(PAGE)
    want = [(1, "u", text, len(text))] * 2 + [(None, None, "", 0), (2, "v", "", 0)]
    assert got == sorted(map(tuple, want), key=str)
    assert htmltext.extract(pages.limit(0)).collect() == []


def test_query_on_given_pages(spark, sf_dir):
    """The given pages hold their article in one element, so brute force can state it."""
    got = {r.page_id: r for r in QUERIES["op3_html_extraction"](spark, sf_dir).collect()}
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1].replace("<br>", " ")
        blocks = re.split(r"</?(?:p|h1)>", article)
        blocks = [html.unescape(re.sub(r"<[^>]+>", "", b)).split() for b in blocks]
        text = "\n\n".join(" ".join(b) for b in blocks if b)
        assert got[r.page_id].text == text and got[r.page_id].n_chars == len(text)
        assert got[r.page_id].url == r.url


@pytest.mark.parametrize(
    "page, kept, gone",
    [
        # a body beside one teaser
        ("<article><a href=x>Teaser</a></article><div>" + f"<p>{PARAGRAPH}</p>" * 6 + "</div>", 6, "Teaser"),
        # a body partly outside its element, before and after it
        (f"<p>{PARAGRAPH}</p><main>" + f"<p>{PARAGRAPH}</p>" * 9 + f"</main><p>{PARAGRAPH}</p><div>Tail</div><div>end</div><div>x</div>", 11, "x"),
        # short lines outside stay outside
        (f"<div>One short advert here.</div><article><h1>T</h1><p>{PARAGRAPH}</p></article><p>Imprint</p>", 1, "Imprint"),
    ],
)
def test_method_decides_beside_stated_regions(page, kept, gone):
    blocks = htmltext.main_text(page).split("\n\n")
    assert blocks.count(PARAGRAPH.strip()) == kept and gone not in blocks


@pytest.mark.parametrize(
    "start, end",
    [
        ("<div class='content-sidebar-wrap'><main>", "</main><div class=sidebar>side</div></div>"),
        ("<div class='container sidebar-right'><article>", "</article></div>"),
        ("<form id=aspnetForm><div class=page><main>", "</main></div></form>"),
        ("<form id=aspnetForm><div class=page>", "</div></form>"),
        ("<div class='content-sidebar-wrap'>", "<div class=ad>Buy it now.</div></div>"),
        ("<nav><main>", "</main></nav>"),
    ],
)
def test_wrappers_with_the_article_stay(start, end):
    page = f"<nav><a href=x>Home</a></nav>{start}<h1>T</h1>" + f"<p>{PARAGRAPH}</p>" * 5 + f"{end}<footer>f</footer>"
    assert htmltext.main_text(page) == "\n\n".join(["T"] + [PARAGRAPH.strip()] * 5)


def test_longer_comments_stay_out():
    page = f"<article><p>{PARAGRAPH}</p></article><div class=comments>" + f"<p>{PARAGRAPH}</p>" * 2 + "</div>"
    assert htmltext.main_text(page) == PARAGRAPH.strip()


@pytest.mark.parametrize(
    "start",
    [
        "<html><head><title>x</title><meta charset=utf-8><body><article>",
        "<head><style>p{}</style><div><article>",
        "<body><iframe src=x><article>",
        "<body><article><button>Buy",
        "<body><select><option>a<option>b<article>",
        "<body><main><p><button>one<button>two</button>",
        "<div><iframe src=x></div><article>",
    ],
)
def test_elements_left_open_do_not_swallow_the_page(start):
    page = start + f"<p>{PARAGRAPH}</p>" * 3
    assert htmltext.main_text(page) == "\n\n".join([PARAGRAPH.strip()] * 3)


def test_text_ends_a_head():
    assert htmltext.main_text(f"<head><title>t</title> {PARAGRAPH}") == PARAGRAPH.strip()


def test_an_aside_left_open_holds_one_line():
    page = f"<article><p>{PARAGRAPH}</p><aside>Note.<p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></article>"
    assert htmltext.main_text(page) == "\n\n".join([PARAGRAPH.strip()] * 3)


def test_formulas_stay():
    page = "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> hold.</p></article>"
    assert htmltext.main_text(page) == "Let x=1 hold."


def test_a_paragraph_of_one_link_between_paragraphs_stays():
    page = f"<body><p>{PARAGRAPH}</p><p><a href=x>The whole report.</a></p><p>{PARAGRAPH}</p>"
    assert htmltext.main_text(page).split("\n\n")[1] == "The whole report."


def test_related_work_is_no_list_of_related_pages():
    page = f"<article><p>{PARAGRAPH}</p><section id='related-work'><p>{PARAGRAPH}</p></section></article>"
    assert htmltext.main_text(page).count(PARAGRAPH.strip()) == 2
