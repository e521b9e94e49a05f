import html
import re
import time

import pytest
from pyspark.sql import types as T

from merchantry.llm import main_text
from merchantry.llm.rows import table

CASES = {
    "": "", "plain text only": "plain text only", "<p>a<p>b &amp; c&nbsp;d <script>x": "a b & c d",
    "<html><head><title>T</title><style>p{}</style></head><body><article><h1>Head</h1><p>One  <b>bold</b>text.<br>Two</p></article></body></html>":
        "Head One boldtext. Two",
    "<body><nav><a>m</a></nav><div class='cookie-notice'>We use cookies</div><main><header><h1>Own header</h1></header><p>The text.</p>"
    "<form><input><p>Your mail</p></form><section id='comments'><p>A long reader comment that is text too</p></section></main>"
    "<aside>other</aside><footer>&copy; x</footer></body>": "Own header The text.",
    "<div id=\"menu\"><a>x</a></div><div class=\"post\"><h1>Title</h1><p>Some long text of the article that matters.</p><p>Short.</p></div>"
    "<div><a>l</a> <a>k</a> <a>j</a></div>": "Title Some long text of the article that matters. Short.",
    "<article><p>cut off in the mid": "cut off in the mid",
    "<article><p>a &lt;b&gt; &#65;&#x42; &eacute;</p><!-- <p>no</p> --><script>var t=\"</p>\"</script><p>end</p>": "a <b> AB é end",
}


@pytest.mark.parametrize("page", CASES)
def test_cases(page):
    assert main_text.extract(page) == CASES[page]


LONG = "A long sentence of the text itself, which goes on for a good while and says something about its matter. " * 3
LINKS = "".join(f"<li><a href='/{k}'>Link {k}</a></li>" for k in range(6))
TEASERS = "".join(f"<article><h3><a href='/{k}'>Other {k}</a></h3><p>Few words.</p><p><a href='/{k}'>More</a></p></article>" for k in range(5))
POST = f"<h1>Title</h1><p>{LONG}1</p><p>{LONG}2</p><p>Short.</p><p>{LONG}3</p><p>{LONG}4</p>"
POST_TEXT = f"Title {LONG}1 {LONG}2 Short. {LONG}3 {LONG}4"


@pytest.mark.parametrize("page", [
    # teaser cards are articles, the text is not
    f"<body><nav><ul>{LINKS}</ul></nav><div>{POST}</div><div>{TEASERS}</div><footer>c</footer></body>",
    f"<body><div>{TEASERS}</div><div>{POST}</div></body>",
    # one article and cards
    f"<body><article>{POST}</article><div>{TEASERS}</div></body>",
    # unnamed links inside of main and of an article
    f"<main>{POST}<ul>{LINKS}</ul><div><a href='/x'>Buy one now</a></div></main>",
    f"<article>{POST}<ul>{LINKS}</ul><div><a href='/x'>Buy one now</a></div></article>",
    # parts of an article
    f"<nav><ul>{LINKS}</ul></nav><article><div><h1>Title</h1></div><div><p>{LONG}1</p><p>{LONG}2</p><p>Short.</p></div><section><p>{LONG}3</p>"
    f"<p>{LONG}4</p></section></article>",
    # no article at all
    f"<body><div><ul>{LINKS}</ul></div><div>{POST}</div><div><ul>{LINKS}</ul></div></body>",
])
def test_ratios_choose_on_every_page(page):
    assert main_text.extract(page) == POST_TEXT


NAV, FOOT = f"<nav><ul>{LINKS}</ul></nav>", "<footer>c</footer>"


@pytest.mark.parametrize("page", [
    # wrappers that tell of a sidebar or of comments
    f"<div class='layout with-sidebar'>{NAV}<article>{POST}</article><div class='sidebar'>{LONG}</div></div>",
    f"<div id='page-has-nav'><div>{POST}</div></div>{FOOT}",
    f"<div class='sidebar-left'><div class='nav-bar'>{LONG}</div><article>{POST}</article></div>",
    f"<div class='sidebar-left'><div class='share'>{LONG}</div><div>{POST}</div></div>",
    f"<form id='search'><article>{POST}</article></form>",
    f"<div id='comments'><main>{POST}</main></div>",
    # parts left open before the article
    f"<div class='ad'>Buy<article>{POST}</article>{FOOT}",
    f"<nav><ul>{LINKS}</ul><main>{POST}</main>{FOOT}",
    f"<div><aside>{LONG}<article>{POST}</article></div>{FOOT}",
    # closed ones hold their articles
    f"<article>{POST}</article><aside><article><p>{LONG}</p></article></aside>",
    f"<div>{POST}</div><section id='comments'><article><p>{LONG}</p></article></section>",
    # articles that are comments or adverts themselves
    f"<article>{POST}</article><article class='comment'><p>{LONG}</p></article><article id='reply-7'><p>{LONG}</p></article>",
    f"<article>{POST}<article class='user-comment'><p>{LONG}</p></article></article>",
    f"<article class='sponsored'><p>{LONG}</p></article><article class='post comments-open category-ads tag-comment has-ads'>{POST}</article>",
])
def test_names_of_wrappers_and_articles(page):
    assert main_text.extract(page) == POST_TEXT


PARA = "Some words of a paragraph that goes on for a while. " * 6
SECTIONS = "".join(f"<section><h2>Part {k}</h2><p>{'Words of a section. ' * (k * k + 1)}</p></section>" for k in range(5))


@pytest.mark.parametrize("page", [
    # nothing but text
    f"<body><div><p>{PARA}</p></div><div><p>{PARA}</p></div></body>",
    f"<body><p>{PARA}<p>{PARA}<p>Short.<p>{PARA}</body>",
    f"<main>{SECTIONS}</main>",
    f"<body><div>{NAV}</div><div id=story><div>{LONG}</div><div>One.</div><div>Two.</div><div>Three.</div><div>{LONG}</div></div>{FOOT}</body>",
    # elements left open before the text
    f"<head><title>t</title><meta x><body><p>{PARA}</p></body>",
    f"<head><title>t</title><p>{PARA}</p>",
    f"<button>Go<article>{POST}</article>", f"<select><option>One<main>{POST}</main>",
])
def test_whole_texts(page):
    shown = re.sub(r"<head>.*?</title>|<meta x>|<nav>.*?</nav>|<footer>.*?</footer>|<button>Go|<select><option>One", "", page)
    assert main_text.extract(page) == " ".join(re.sub("<[^>]*>", " ", shown).split())


@pytest.mark.parametrize("part", ["<div class=ad>", "<a <", "<article class=comment>", "<b>", "</b></i></x>", "<p><b>", "<!--", "<![", "<li><ul>", "<div><p>x</x>"])
def test_deep_and_unfinished_pages(part):
    """A hundred thousand tags take time in proportion."""
    start = time.process_time()
    sum(range(5_000_000))
    unit = time.process_time() - start
    start = time.process_time()
    main_text.extract(f"<article><p>{LONG}</p></article>" + part * 100_000)
    assert time.process_time() - start < max(10, 60 * unit)


def test_short_items_of_a_list_stay_in_their_text():
    page = f"<article><p>{LONG}</p><ul><li>Milk</li><li>Two eggs</li><li>Salt</li></ul><p>{LONG}</p></article>"
    assert main_text.extract(page) == f"{LONG}Milk Two eggs Salt {LONG}".strip()


def test_articles_of_the_given_pages(spark, sf_dir):
    """The article element's own text, taken out with patterns."""
    pages = table(spark, sf_dir, "pages")
    found = {r.page_id: (r.text, r.n_chars) for r in main_text.extracted_pages(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        want = " ".join(html.unescape(re.sub(r"<[a-z/][^>]*>", " ", re.sub(r"</?b>", "", inner))).split())
        assert found[r.page_id] == (want, len(want))


def test_awkward_rows(spark):
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                           T.StructField("HTML", T.StringType()), T.StructField("text", T.StringType())])
    long = "<article>" + "<p>para graph</p>" * 20_000 + "</article>"
    rows = [(1, "u", None, "x", "y"), (1, "u", None, "x", "y"), (None, None, "<p>é𝄞", None, None), (2, "u", long, "", ""), (3, "u", "<" * 5000, "", "")]
    got = main_text.extracted_pages(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 5
    by = {(r.page_id, r.url): (r.text, r.n_chars) for r in got}
    assert by[1, "u"] == ("", 0) and by[None, None] == ("é𝄞", 2) and by[2, "u"][1] == 20_000 * 11 - 1
    assert main_text.extracted_pages(spark.createDataFrame([], schema)).count() == 0


def test_smoothing_keeps_the_level():
    import numpy as np
    assert main_text.smoothed(np.ones(7)) == pytest.approx(np.ones(7))
