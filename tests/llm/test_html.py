"""Main text of pages: planted templates, a plain reading of the given pages, odd pages."""

import html
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from starmart.llm import html_text
from starmart.llm.html_text import main_text, parsed, smoothed, threshold

LONG, MORE = "word " * 50, "more " * 40
PAGES = {
    "no article element": ("<body><div><a href=1>Home</a> <a href=2>About us</a></div><div><h2>Title here</h2><p>" + LONG + "</p><p>Short.</p><p>" + MORE + "</p></div><div>Copyright 2020</div></body>",
                           f"Title here {LONG}Short. {MORE}"),
    "what an article holds besides": ("<nav><a>x</a><article><h1>T</h1><p>Body &amp; soul&nbsp;x</p><aside>no</aside><section class='comments'><article>hi</article></section><form><input><label>n</label>f</form></article>", "T Body & soul x"),
    "inline elements do not part words": ("<article>a<b>b</b>c<br>d\n\t e</article>", "abc d e"),
    "headers": ("<header>Site</header><main><header><h1>T</h1><p>by me</p></header><p>One.</p><footer>f</footer></main><footer>z</footer>", "T One."),
    "names of classes": ("<div class='cookie-notice'>We use cookies, a text that goes on and on</div><article><p>Hi.</p><div class=ad>Buy!</div><p>Ho.</p></article><div id=sidebar>" + LONG + "</div>", "Hi. Ho."),
    "a form round the page": ("<form><article><p>In form</p></article></form>", "In form"),
    "teasers in an aside": ("<article><p>" + LONG + "</p></article><aside><article>Other</article></aside>", LONG),
    "several articles": ("<article><p>" + LONG + "</p></article><article><p>teaser</p></article>", LONG),
    "scripts": ("<article><script>var a='</p>';</script><style>p{}</style>x<noscript>y</noscript></article>", "x"),
    "unclosed": ("<body><p><b>One<br><p>two</p><p>three", "One two three"),
    "names leave nothing": ("<div class=ad><p>Only this</p></div>", "Only this"),
    "plain": ("  plain text\n only ", "plain text only"),
    "nothing": ("", ""),
    "no text": ("<article><p> </p></article><footer>x</footer>", ""),
    "an open comment": ("<p>a</p><!-- b <p>c</p>", "a"),
    "a broken declaration": ("<![foo <p>x</p>", "x"),
    "references": ("<article>&lt;b&gt; &#65;&#x42; &eacute; &quot;q&quot; &am</article>", "<b> AB é \"q\" &am"),
}


@pytest.mark.parametrize("name", PAGES)
def test_planted(name):
    page, want = PAGES[name]
    assert main_text(page) == " ".join(want.split())


def test_lines_and_clusters():
    page = parsed("<div><p>one <i>two</i></p><a>three</a></div>four")
    assert page.text == ["one two", "three", "four"] and page.linked == [0, 5, 0] and page.tags[0] == 5
    assert smoothed(np.array([0.0, 0, 9, 0, 0])).argmax() == 2
    assert 2 < threshold(np.array([1.0, 1.5, 2, 8, 9, 10])) < 8


def test_deep_and_long_pages():
    assert main_text("<div>" * 20000 + "x" + "</div>" * 20000) == "x"
    assert len(main_text("<article>" + "<p>a b c" * 50000)) == 50000 * 6 - 1


def test_whole_table(spark):
    """The given pages hold their article in one element; read it with plain patterns."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        text = " ".join(html.unescape(re.sub(r"</?(p|br|h1)[^>]*>", " ", article).replace("<b>", "").replace("</b>", "")).split())
        assert got[r["page_id"]] == (r["url"], text, len(text))


def test_odd_rows(spark):
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), *[T.StructField(c, T.IntegerType()) for c in ("text", "n_chars", "line")]])
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<p>🙂 é"), (2, "u", "<p>🙂 é"), (3, "", "<article>" + "<p>x " * 30000)]
    got = html_text.extract(spark.createDataFrame([(*r, 1, 2, 3) for r in rows], schema)).collect()
    assert sorted(((r["page_id"], r["url"], r["n_chars"]) for r in got), key=str) == sorted([(1, None, 0), (None, "u", 0), (2, "u", 3), (2, "u", 3), (3, "", 59999)], key=str)
    assert html_text.extract(spark.createDataFrame([], schema)).collect() == []
