import re
import time
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from docmill.llm import block_lstm
from docmill.llm.html_extract import extract, labelled, train
from docmill.llm.html_leaves import Examples, features, leaves


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def model(pages):
    return train(pages)


class Article(HTMLParser):
    """Blocks of ``article``, another parser's way; void and inline elements of the table's pages only."""

    def __init__(self):
        super().__init__()
        self.blocks, self.inside, self.text = [], False, []

    def cut(self):
        words = "".join(self.text).split()
        if words and self.inside:
            self.blocks.append(" ".join(words))
        self.text = []

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text.append(" ")
        elif tag not in ("b", "a"):
            self.cut()
        self.inside |= tag == "article"

    def handle_endtag(self, tag):
        if tag not in ("b", "a"):
            self.cut()
        if tag == "article":
            self.inside = False

    def handle_data(self, data):
        self.text.append(data)


def test_articles_of_the_table(spark, pages, model):
    wanted = {}
    for r in pages.collect():
        parser = Article()
        parser.feed(r.html)
        parser.close()
        wanted[r.page_id] = (r.url, "\n\n".join(parser.blocks))
    found = {r.page_id: (r.url, r.text) for r in extract(pages, model).where("n_chars = length(text)").collect()}
    assert found.keys() == wanted.keys() and sum(found[k] == wanted[k] for k in wanted) >= 0.99 * len(wanted)


def test_held_out_layouts(model):
    made = Examples(sorted(set(re.findall("[a-z]+", Examples.__doc__ or "x y"))) + [f"w{k}" for k in range(500)], seed=99)
    good = total = 0
    for _ in range(300):
        page = made.page()
        for (_, main), leaf in zip(labelled(model, [page])[0], leaves(page)):
            good += main == (leaf.label == 1)
            total += 1
    assert good >= 0.98 * total


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body>
<header class="site-header"><a href="/">The Site</a></header><nav class="main-menu"><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div id="cookie-banner" class="cookie-notice"><p>We use cookies on this site. Accept them to go on reading what we write.</p><button>Accept</button></div>
%s<h1>How  the   bridge was built</h1><p>The first stones were laid in spring, when the river was low&nbsp;&amp; calm. Forty people worked there.</p>
<div class="ad">Buy a new car today, at a good price.</div>
<p>By autumn the arch stood, and <b>the road</b> was opened<br>for carts.</p><ul><li>It took two hundred days.<li>It cost a fortune.</ul>%s
<aside class="sidebar"><h3>Related</h3><ul><li><a href=/c>Other bridges of the valley</a></ul></aside>
<form action=/s><label>Your mail</label><input name=m><button>Subscribe</button></form>
<section id="comments" class="comments"><h3>2 comments</h3><div class="comment"><p>I crossed it last year, it is lovely to see. Thank you for this text.</p></div></section>
<footer>&copy; 2020 The Site. All rights reserved.</footer><script>var a = "<p>no</p>";</script></body></html>"""
TEXT = "\n\n".join([
    "How the bridge was built", "The first stones were laid in spring, when the river was low & calm. Forty people worked there.", "By autumn the arch stood, and the road was opened for carts.",
    "It took two hundred days.", "It cost a fortune.",
])


@pytest.mark.parametrize("around", ["<article>|</article>", "<main><article class=post>|</article></main>", '<div class="content">|</div>', '<div id="wrap"><div class="post-body">|</div></div>', "<main>|</main>"])
def test_a_page_with_all_parts(model, around):
    page = PAGE % tuple(around.split("|"))
    assert "\n\n".join(t for t, main in labelled(model, [page])[0] if main) == TEXT


def test_leaves():
    html = "a<p>b <i>c</i>d&amp;<br>e<p> \n <div>f<script>x</script>g<title>h</title></div>i<table><tr><td>1<td>2</table><a href=x>link</a> no"
    assert [x.text for x in leaves(html)] == ["a", "b cd& e", "f", "g", "i", "1", "2", "link no"]
    assert [round(x.linked, 2) for x in leaves("<a>ab</a>cd<p><a>x")] == [0.5, 1.0]
    one, two, three = leaves("<nav class='x'><p>a</p></nav><nav class='x'><p>b</p></nav><p>c</p>")
    assert one.path == two.path != three.path


def test_gradients_are_those_of_the_loss():
    made = Examples(["one", "two", "three"], seed=1)
    pages = [p for p in (leaves(made.page()) for _ in range(6)) if p]
    x, labels = features(pages), np.array([leaf.label for p in pages for leaf in p])
    labels[::7] = -1
    p = {k: v.astype(np.float64) for k, v in block_lstm.fresh(3).items()}
    _, g = block_lstm.gradients(p, x, labels)
    rng = np.random.default_rng(0)
    for name, values in p.items():
        strongest = np.argsort(-np.abs(g[name]).ravel())[:3].tolist() + rng.integers(0, values.size, 2).tolist()
        for k in strongest:
            at = np.unravel_index(k, values.shape)
            ends = []
            for step in (1e-3, -1e-3):
                values[at] += step
                ends.append(block_lstm.gradients(p, x, labels)[0])
                values[at] -= step
            assert abs((ends[0] - ends[1]) / 2e-3 - g[name][at]) < 2e-3 * max(1, abs(g[name][at]) * 10), (name, at)


def test_pages_together_or_alone_score_alike(model):
    made = Examples(["one", "two", "three"], seed=2)
    pages = [leaves(made.page()) for _ in range(40)]
    for page, odds in zip(pages, block_lstm.scores(model, features(pages))):
        assert len(page) == len(odds)
        if page:
            assert np.allclose(odds, block_lstm.scores(model, features([page]))[0], atol=1e-3)


def test_edges(spark, model):
    html = [None, "", "   ", "<", "no tags at all", "<p>", "<article><p>One sentence that is here, twice.</article>", "<article><p>One sentence that is here, twice.</article>", "&amp;&#0;&bogus;<p", "<body><nav>a</nav>"]
    rows = [(k if k % 3 else None, None if k == 4 else f"u{k}", t) for k, t in enumerate(html)]
    docs = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("t")).withColumn("n_chars", F.lit(1)).withColumn("key", F.lit("k"))
    out = extract(docs, model).collect()
    assert sorted(((r.page_id, r.url) for r in out), key=str) == sorted(((p, u) for p, u, _ in rows), key=str)
    assert [r.text for r in out if r.url in ("u0", "u1", "u2")] == ["", "", ""] and all(r.n_chars == len(r.text) for r in out)
    assert [r.text for r in out if r.url in ("u6", "u7")] == ["One sentence that is here, twice."] * 2
    empty = docs.where("false")
    assert extract(empty, model).collect() == []
    assert extract(docs, train(empty)).count() == len(rows)


def test_long_and_deep_pages(model):
    many = "<article>" + "".join(f"<p>Sentence number {k} stands here, as it should.</p>" for k in range(20_000)) + "</article><footer>Contact us</footer>"
    deep = "<div class='a'>" * 20_000 + "<p>text</p>"
    start = time.time()
    found = labelled(model, [many, deep, "<article><p>" + "word " * 200_000 + ".</article>"])
    assert time.time() - start < 60
    assert [main for _, main in found[0]] == [True] * 20_000 + [False] and len(found[1]) == 1 and len(found[2][0][0]) == 1_000_001
