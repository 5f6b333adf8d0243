import random
import time

from docmill.functions.html import CLOSE, OPEN, TEXT, walk


def shown(html):
    out = []
    for kind, value, attributes in walk(html):
        out.append(value if kind == TEXT else f"</{value}>" if kind == CLOSE else f"<{value}{''.join(f' {k}={v}' for k, v in attributes.items())}>")
    return "".join(out)


def test_events():
    cases = {
        "<p>a<p>b": "<p>a</p><p>b</p>",
        "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "<ul><li>a</li><li>b<ul><li>c</li></ul></li><li>d</li></ul>",
        "<p><b>a<br><p>b</article>": "<p><b>a<br></br></b></p><p>b</p>",
        "<table><tr><td>a<td>b<tr><td>c</table>d": "<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>d",
        "<td><p>x<table><tr><td>y</p>z": "<td><p>x</p><table><tr><td>yz</td></tr></table></td>",
        "<b><p>x</b>y</p>z": "<b><p>xy</p>z</b>",
        "a < b <3 & &amp; &lt;p&gt; &copy 1": "a < b <3 & & <p> © 1",
        '<a href="x>y" T=\'1\' u=v w>k</a>': "<a href=x>y t=1 u=v w=>k</a>",
        "<script>var t='</p>';</script>x<style>p{}</STYLE >y": "<script>var t='</p>';</script>x<style>p{}</style>y",
        "<title>a &amp; <b></title>x": "<title>a & <b></title>x",
        "a<!-- <p> -->b<!-->c<!doctype html>d<?x y>e</>f<!-- open": "abcdef",
        "x<a href='open": "x",
        "<dl><dt>a<dd>b<dt>c</dl>": "<dl><dt>a</dt><dd>b</dd><dt>c</dt></dl>",
        "<DIV><img src=a/>x<br/>y</Div></div>": "<div><img src=a/></img>x<br></br>y</div>",
        "<select><option>a<option>b</select>": "<select><option>a</option><option>b</option></select>",
    }
    for html, wanted in cases.items():
        assert shown(html) == wanted, html


def test_events_are_balanced_on_any_text():
    rng = random.Random(1)
    parts = ["<p>", "</p>", "<div class='a b'>", "</div>", "<li>", "<ul>", "</ul>", "<td>", "<tr>", "<table>", "</table>", "<b>", "</b>", "<a href=x>", "</a>", "x", "<", ">", "'", '"', "&", "&lt;", "<!--", "-->", "<script>", "</script>", "<br>", "<button>", "</button>", "<dd>", "<dl>", "="]
    for _ in range(3000):
        html = "".join(rng.choice(parts) for _ in range(rng.randrange(40)))
        open_names = []
        for kind, value, _ in walk(html):
            if kind == OPEN:
                open_names.append(value)
            elif kind == CLOSE:
                assert open_names.pop() == value
        assert not open_names


def test_linear_time():
    n = 100_000
    for html in ("<div>" * n, "<p>" * n, "<b>" * n, "<" * n, "<!--" * n, "<a b='" * n, '<a b="' * n, "</p" * n, "<div><li></li>" * n, "<div>" * n + "<li></li>" * n, "<p><button>" + "<div>" * n, "<table>" * n + "</div>" * n, "<script>" * n, "&" * n, "<td><p>" * n, "<a ==" * n, "<!" * n, "<a b= " * n):
        start = time.time()
        for _ in walk(html):
            pass
        assert time.time() - start < 5, html[:20]
