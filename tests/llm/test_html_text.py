from __future__ import annotations

import html
import re

import pytest

from duelframe.llm import html_text
from duelframe.llm.common import ship
from duelframe.llm.queries import QUERIES

CASES = {
    "": "",
    "plain text &amp; so": "plain text & so",
    "<p>un&#99;losed <b": "unclosed",
    "<p>a &lt; b &amp;lt; c&nbsp;d</p>": "a < b &lt; c d",
    "a < b and c > d <p>x</p>": "a < b and c > d\nx",
    "<script>if (a < b) { '</p>' }</script><style>p{}</style><!-- gone <p>x</p> -->": "",
    "<p>One<!-- cut off <p>Two": "One",
    '<div title="a > b">Yes, this. And that.</div>': "Yes, this. And that.",
    "<article><h1>Title</h1><p>First\n  line<br><p><b>Sec</b>ond, <i>line</i></article><footer>no</footer>": "Title\nFirst line\nSecond, line",
    "<nav><ul><li><a href=/>Home</a></ul></nav><main><ul><li>one, two<li>three</ul><aside>x</aside></main>": "one, two\nthree",
    '<body class="has-sidebar"><div class="post"><h2>Head</h2><p>Some text, long enough. To count.</p></div><div id="comments"><p>Nice, very nice. Indeed.</p></div>': "Head\nSome text, long enough. To count.",
    '<article><header><h1>T</h1><p>by me</p></header><p>Body.</p><div class="share">Tweet</div><form>mail <input></form></article><article class="comment"><p>Reply text.</p></article>': "T\nBody.",
    '<div id="cookie-notice">We use cookies, fine?</div><div><p>A story, told at length. It ends well.</p><p>Short.</p></div><p><a href=x>More stories, all of them links</a></p>': "A story, told at length. It ends well.\nShort.",
}

LONG = "A long sentence of the story, with a comma. And a second one, which ends here."
CASES |= {
    # sibling articles, of different classes too
    f'<main><article class="lead"><h2>One</h2><p>{LONG}</p></article><article class="other"><h2>Two</h2><p>{LONG}</p><p>Short.</p></article></main>': f"One\n{LONG}\nTwo\n{LONG}\nShort.",
    # class words within an article tell little, but for a few
    f'<article><h1>T</h1><p>{LONG}</p><p class="legal">{LONG}</p><div class="discussion"><p>{LONG}</p></div></article>': "\n".join(["T", LONG, LONG, LONG]),
    f'<article><p>{LONG}</p><div class="tags">news</div><section class="comments"><p>{LONG}</p></section><div class="sponsored">{LONG}</div></article>': LONG,
    # lists stay, lists of links and who wrote it don't
    f'<article><p>{LONG}</p><ul><li>one<li>two</ul><ul class="more"><li><a href=x>Another story, which is long</a><li><a href=y>And one more, also long</a></ul><p>{LONG}</p><div class="author-box">Jane Doe writes about stories, often.</div></article>': f"{LONG}\none\ntwo\n{LONG}",
    # no article element: the content nodes' elements
    f'<div id="page"><div id="top">Site name</div><div class="post"><h1>T</h1><section><h2>A</h2><p>{LONG}</p></section><section><p>{LONG}</p><ul><li>x<li>y</ul></section></div><div>Imprint</div></div>': f"T\nA\n{LONG}\n{LONG}\nx\ny",
    f"<body><h1>T</h1><p>{LONG}</p><p>{LONG}</p><div><a href=x>All stories</a></div></body>": f"T\n{LONG}\n{LONG}",
}


@pytest.mark.parametrize("page", CASES)
def test_cases(page):
    assert html_text.main_text(page)[0] == CASES[page]


def test_many_tags_and_no_end():
    page = "<div>" * 3000 + "deep, text." + "<p>x" * 2000
    assert html_text.main_text(page)[0].startswith("deep, text.")
    assert html_text.main_text('<a href="' + "x" * 100_000)[0] == ""


def test_articles_of_all_pages(spark):
    """In these pages the article is one element, with blocks at p, h1 and br, and b within lines."""
    folder = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = QUERIES["op8_tag_path_ratios"](spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inside = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r["page_id"]], re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", inside)]
        assert r["text"] == "\n".join(x for x in blocks if x) and r["n_chars"] == len(r["text"])


def test_articles_need_no_article_element(spark):
    """The same pages with plain elements for the articles, and with two articles of each page."""
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        page, text = r["html"], html_text.main_text(r["html"])[0]
        plain = re.sub(r"<(/?)article\b", r"<\1div", page)
        assert html_text.main_text(plain)[0] == text
        if "</article>" in page and text:
            start, end = page.index("<article>"), page.index("</article>") + len("</article>")
            twice = page[:end] + page[start:end] + page[end:]
            assert html_text.main_text(twice)[0] == f"{text}\n{text}"


def test_edge_rows(spark):
    ship(spark)
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "u", "<p>Text.</p>"), (3, "u", "<p>Text.</p>"), (3, "u", "<p>Text.</p>"), (4, "u", "<p>" + "Many words. " * 50_000)], "page_id long, url string, html string")
    pages = pages.selectExpr("*", "'clash' AS text", "'clash' AS n_chars")
    rows = html_text.extract(pages).collect()
    assert sorted(len(r["text"]) for r in rows) == [0, 0, 5, 5, 5, 12 * 50_000 - 1]
    assert html_text.extract(pages.limit(0)).count() == 0
