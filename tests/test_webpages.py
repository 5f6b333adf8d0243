import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from docmill.sources.webpages import extract, to_markdown

CASES = {
    "<h1>One  two</h1><p>a <b>bold</b> and <i> it </i>&amp; <code>x=1</code><p>next<br>line": "# One two\n\na **bold** and *it* & `x=1`\n\nnext\nline",
    "<ul><li>a<li>b<ul><li>c<li>d</ul><li>e</ul>": "- a\n- b\n  - c\n  - d\n- e",
    "<ol><li>a<p>more</p><li>b<ol><li>c</ol></ol>x": "1. a\n   more\n2. b\n   1. c\n\nx",
    "<table><tr><th>K<th>V<tr><td>a|b<td>1<tr><td><b>c</b></table>": "| K | V |\n|---|---|\n| a\\|b | 1 |\n| **c** |  |",
    "<p>see <a href='/x?a=1&amp;b=2'>the <b>page</b></a> or <a>none</a>": "see [the **page**](http://h.org/x?a=1&b=2) or none",
    "<blockquote><p>q</p><p>r</blockquote><hr><pre>a\n  b</pre>": "> q\n>\n> r\n\n---\n\n```\na\n  b\n```",
    "<head><title>t</title></head><nav>n</nav><script>s('<p>')</script>x<footer>f</footer><!-- c -->y<img src=a.png alt='A  b'>": "x\n\ny![A b](http://h.org/a.png)",
    "<div>a<div>b</div>c</div><h2><a href=#k>H</a></h2>": "a\n\nb\n\nc\n\n## [H](http://h.org/#k)",
    "<table><tr><td>a<table><tr><td>b<td>c</table>d</table>": "| a b c d |\n|---|",
    "<a href=u><div>x</div><div>y</div></a>": "[x y](http://h.org/u)",
    "": "", "  ": "", "<p></p><ul><li></ul><table></table><blockquote></blockquote><pre></pre><b></b>": "",
}


@pytest.mark.parametrize("html", CASES)
def test_markdown(html):
    assert to_markdown(html, "http://h.org/") == CASES[html]


def test_pages_and_errors(spark):
    rows = spark.createDataFrame([("a", "<p>x", "http://h.org"), ("b", None, None), (None, "<a href='http://[bad'>y</a>", "http://h.org"), ("c", "<h1>z", None)], "page string, html string, url string")
    out = extract(rows.withColumn("source", F.lit(1)), "page", base="url").collect()
    assert [(r.source, r.markdown) for r in out] == [("a", "x"), ("b", None), (None, None), ("c", "# z")]
    assert [bool(r.error) for r in out] == [False, True, True, False]
    assert extract(rows.limit(0), "page").count() == 0


def test_any_text_takes_time_in_proportion():
    n = 30_000
    for html in ("<ul><li>" * n, "<b>" * n + "x", "<a href=x>" * n + "y", "<table><tr><td>" * n, "<blockquote>" * n + "q", "<p>x" * n, "<ul>" + "<li>x" * n, "<table>" + "<tr><td>a<td>b" * n, "<pre>" * n, "<h1>" * n + "x", "<ul><li>x" * n, "<blockquote>y" * n):
        start = time.time()
        to_markdown(html)
        assert time.time() - start < 10, html[:20]


class Plain(HTMLParser):
    """The table's pages by another parser: what is between block tags, outside head, nav and footer."""

    def __init__(self):
        super().__init__()
        self.blocks, self.out, self.text, self.head = [], 0, [], ""

    def cut(self):
        words = "".join(self.text).split()
        if words:
            self.blocks.append(self.head + " ".join(words))
        self.text = []

    def handle_starttag(self, tag, attrs):
        if tag not in ("b", "a", "br"):
            self.cut()
            self.head = "# " if tag == "h1" else ""
        self.out += tag in ("head", "nav", "footer")

    def handle_endtag(self, tag):
        if tag not in ("b", "a"):
            self.cut()
            self.head = ""
        self.out -= tag in ("head", "nav", "footer")

    def handle_data(self, data):
        if not self.out:
            self.text.append(data)


def test_query_equals_a_plain_parser(spark):
    from docmill import catalog

    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    found = catalog.QUERIES["q_html_markdown"](spark, "/root/testdata/sf0.01").collect()
    assert len(found) == len(pages)
    for r in found:
        parser = Plain()
        parser.feed(pages[r.page_id])
        parser.close()
        assert r.error is None and " ".join(r.markdown.split()) == " ".join("\n\n".join(parser.blocks).split()), r.page_id
