"""Leaf blocks of web pages, their features, and laid-out example pages to learn from.

A leaf is the text between two block boundaries, with white space turned into single spaces.  It carries its tag path: hashed names,
class, id and role words of all its ancestors, and again, apart, those of its own block and of that block's parent.  The path is a bitmap that
each element inherits and adds to, so a page takes time in proportion to its size, however deep it nests.
"""

from __future__ import annotations

import random
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from docmill.functions.html import CLOSE, INLINE, OPEN, TEXT, walk
from docmill.llm.common import utf8
from docmill.llm.shingles import _words

PATH_BITS, WORD_BITS = 12, 12
NUMBERS = 5
#: Elements whose text isn't shown or isn't text.
HIDDEN = frozenset("head script style template title noscript svg math object iframe noembed noframes canvas audio video datalist".split())
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SENTENCE = (".", "!", "?", "…", ":", "。", "！", "？")


def _bit(word: str) -> int:
    return 1 << (zlib.crc32(word.encode()) & ((1 << PATH_BITS) - 1))


@dataclass
class Leaf:
    text: str
    path: int
    words: int
    linked: float
    label: int | None = None


@dataclass
class _Open:
    path: int  # of the element and all above it
    own: int  # as the innermost block
    up: int  # as the parent of the innermost block
    hidden: bool
    linked: bool
    block: bool
    label: int | None


#: Roles by what a page's elements are called, for the pages that say where their article is.
_OUTSIDE = frozenset("nav footer aside form menu dialog".split())
_OUTSIDE_WORDS = frozenset("ad ads advert advertisement sponsored promo cookie consent notice comment comments sidebar related share newsletter breadcrumb pagination menu nav footer".split())


def _labelled(name: str, attributes: dict[str, str], words: list[str], inherited: int | None) -> int | None:
    """1 within the article, 0 within what isn't, else what the parent has; ``data-keep`` says so in the examples."""
    if "data-keep" in attributes:
        return int(attributes["data-keep"])
    if name in ("article", "main"):
        return 1 if inherited is None else inherited
    if name in _OUTSIDE or _OUTSIDE_WORDS.intersection(words):
        return 0
    return inherited


def leaves(html: str) -> list[Leaf]:
    out: list[Leaf] = []
    stack = [_Open(0, 0, 0, False, False, True, None)]
    blocks = [0]  # places of open blocks
    texts: list[str] = []
    linked = 0
    known: dict[tuple, tuple[int, int, int, list[str]]] = {}

    def flush() -> None:
        nonlocal linked
        if texts:
            parts = "".join(texts).split()
            if parts:
                block = stack[blocks[-1]]
                up = stack[blocks[-2]].up if len(blocks) > 1 else 0
                text = " ".join(parts)
                out.append(Leaf(text, stack[-1].path | block.own | up, len(parts), min(1.0, linked / len(text)), block.label))
            texts.clear()
            linked = 0

    for kind, value, attributes in walk(html):
        top = stack[-1]
        if kind == TEXT:
            if not top.hidden:
                texts.append(value)
                if top.linked:
                    linked += len(value)
        elif kind == OPEN:
            block = value not in INLINE
            if block:
                flush()
            elif value == "br":
                texts.append("\n")
            key = (value, attributes.get("class", ""), attributes.get("id", ""), attributes.get("role", ""))
            if key not in known:
                words = [w.lower() for w in _PART.findall(" ".join(key[1:]))]
                every = [f"<{value}", *words]
                bits = [0, 0, 0]
                for k, kind_of in enumerate(("", "own ", "up ")):
                    for w in every:
                        bits[k] |= _bit(kind_of + w)
                known[key] = (*bits, words)
            path, own, up, words = known[key]
            stack.append(_Open(top.path | path, own, up, top.hidden or value in HIDDEN, top.linked or value == "a", block, _labelled(value, attributes, words, top.label)))
            if block:
                blocks.append(len(stack) - 1)
        elif kind == CLOSE:
            if top.block:
                flush()
                blocks.pop()
            stack.pop()
    flush()
    return out


@dataclass
class Features:
    """Of leaves one after the other: row of ``paths`` each, word buckets with bounds, and numbers."""

    path: np.ndarray
    paths: np.ndarray  # distinct bitmaps, rows x 2^PATH_BITS
    buckets: np.ndarray
    bounds: np.ndarray
    numbers: np.ndarray
    sizes: list[int] = field(default_factory=list)  # leaves of each page


def features(pages: list[list[Leaf]]) -> Features:
    every = [leaf for page in pages for leaf in page]
    place: dict[int, int] = {}
    path = np.array([place.setdefault(x.path, len(place)) for x in every], np.int64)
    raw = b"".join(m.to_bytes(1 << PATH_BITS >> 3, "little") for m in place)
    paths = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(len(place), -1), axis=1, bitorder="little").astype(np.float32)
    at, data = utf8(pc.utf8_lower(pa.array([x.text for x in every], pa.large_string())))
    hashes, bounds = _words(data[at[0] : at[-1]], at - at[0])
    position = np.concatenate([np.linspace(0, 1, len(p), dtype=np.float32) for p in pages]) if every else np.zeros(0, np.float32)
    words = np.array([x.words for x in every], np.float32)
    commas = np.array([x.text.count(",") for x in every], np.float32)
    numbers = np.stack([np.log1p(words) / 4, np.array([x.linked for x in every], np.float32), np.array([x.text.endswith(_SENTENCE) for x in every], np.float32), commas / np.maximum(words, 1), position], axis=1)
    return Features(path, paths, (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64), bounds, numbers.astype(np.float32), [len(p) for p in pages])


# Example pages: what parts of a page are called, and how they look.  A name is an element with classes (.) and an id (#).
ARTICLE = "article main main>article div.content div#content div.post-body section.entry div.article-text div.story div#main-content div.text section.post div.body article.post div#article".split()
PARTS = {
    "menu": "nav ul.menu div.nav div#navigation div.breadcrumbs div.pagination ul.links div.topbar nav.main-menu div#menu ol.breadcrumb div.toc-links".split(),
    "header": "header div.header div#masthead div.banner div.site-title header.page-header div#top div.logo".split(),
    "footer": "footer div.footer div#bottom div.copyright div.legal div#footer footer.site-footer div.colophon".split(),
    "sidebar": "aside div.sidebar div.widget div.related section.more div.recommended div#side aside.right div.tags div.popular div.share ul.social".split(),
    "notice": "div.notice div.cookie-notice div.alert div.consent div#gdpr div.modal div.popup div.paywall div.cookies div.disclaimer section.warning dialog".split(),
    "advert": "div.ad div.ads div.advert div.sponsored div.promo ins.adsbygoogle div.ad-banner aside.ad div#ad div.advertisement section.sponsor".split(),
    "form": "form div.form div.newsletter form.search div.subscribe form#login div.signup form.contact".split(),
    "comments": "section.comments div.comments div#comments ol.comment-list div.comment-thread section#discussion div.responses div.reviews ul.comments div.reader-comments section.replies".split(),
}
PLAIN = "div div.wrapper div.container div.row section div.inner div.col div#page div.site div.layout div.grid".split()
SAYINGS = {
    "footer": ["© 2021 {w}. All rights reserved.", "&copy; {w} {w}", "Privacy policy", "Terms of use", "Contact us", "{w} &middot; {s}", "Impressum"],
    "notice": ["We use cookies to improve your experience.", "Accept all", "{s} Read our cookie policy.", "Please log in to continue.", "This site uses cookies. {s}", "Notice: {s}", "{s}"],
    "advert": ["Advertisement", "Sponsored", "Buy now: {s}", "{s}", "{s} {s}", "Save 20% today!"],
    "form": ["Subscribe to our newsletter", "Your email", "Name", "Send", "Search", "Log in", "Password", "{w}"],
    "header": ["{w}", "{w} {w}", "{w} news", "Log in", "Welcome to {w}"],
    "sidebar": ["Related articles", "{w} {w} {w}", "Most read", "Share this", "{s}", "Tags", "{w}"],
    "comments": ["{w} says:", "Reply", "3 comments", "Posted by {w} on May 4", "{s}", "{s} {s}", "{s} {s} {s}", "I agree. {s}", "Leave a comment"],
    "menu": ["{w}", "{w} {w}", "Home", "About", "Next", "Contact"],
}


class Examples:
    """Pages laid out at random from a seed, their parts marked with ``data-keep``."""

    def __init__(self, words: list[str], seed: int = 5):
        self.words, self.rng = words or ["lorem"], random.Random(seed)

    def _sentence(self) -> str:
        n = self.rng.choice((2, 4, 7, 10, 15, 24))
        s = " ".join(self.rng.choice(self.words) for _ in range(n)).replace("<", " ").capitalize()
        return s.rstrip(".,;: ") + self.rng.choice("....!?")

    def _said(self, part: str) -> str:
        s = self.rng.choice(SAYINGS[part])
        while "{w}" in s:
            s = s.replace("{w}", self.rng.choice(self.words).strip("<>.,").capitalize() or "x", 1)
        while "{s}" in s:
            s = s.replace("{s}", self._sentence(), 1)
        return s

    def _within(self, name: str, inner: str, keep: int | None = None) -> str:
        for k, one in enumerate(reversed(name.split(">"))):
            element, *rest = re.split(r"(?=[.#])", one)
            classes = [r[1:] for r in rest if r[0] == "."]
            if self.rng.random() < 0.15:
                classes.append(self.rng.choice(("clearfix", "x" + str(self.rng.randrange(99)), "js", "left", "module", "block")))
            attributes = f' class="{" ".join(classes)}"' if classes else ""
            attributes += "".join(f' id="{r[1:]}"' for r in rest if r[0] == "#")
            if keep is not None and k == name.count(">"):
                attributes += f' data-keep="{keep}"'
            inner = f"<{element}{attributes}>{inner}</{element}>"
        return inner

    def _part(self, part: str) -> str:
        rng = self.rng
        said = [self._said(part) for _ in range(rng.choice((1, 1, 2, 3, 5, 8)))]
        if part in ("menu", "sidebar", "footer") and rng.random() < 0.7:
            said = [f'<a href="/x">{s}</a>' for s in said]
        if part == "form":
            inner = "".join(rng.choice((f"<label>{s}</label><input name=a>", f"<button>{s}</button>", f"<p>{s}</p>", f"<select><option>{s}<option>{s}</select>")) for s in said)
        elif rng.random() < (0.8 if part == "menu" else 0.3):
            inner = "<ul>" + "".join(f"<li>{s}</li>" for s in said) + "</ul>"
        elif rng.random() < 0.3 and len(said) == 1:
            inner = said[0]
        else:
            inner = "".join(rng.choice((f"<p>{s}</p>", f"<div>{s}</div>", f"<p>{s}", f"<h3>{s}</h3>" if len(s) < 40 else f"<p>{s}</p>")) for s in said)
        if part == "comments":
            inner = "".join(self._within(rng.choice(("div.comment", "li.comment", "article.comment", "div.reply", "div")), inner) for _ in range(rng.choice((1, 2, 3))))
        return self._within(rng.choice(PARTS[part]), inner, 0)

    def _article(self) -> list[str]:
        rng, out = self.rng, []
        if rng.random() < 0.85:
            out.append(f"<h1>{self._sentence()[:60]}</h1>")
        for _ in range(rng.choice((0, 1, 2, 4, 7, 12))):
            kind, many = rng.random(), [self._sentence() for _ in range(rng.choice((1, 1, 2, 4, 6)))]
            s = " ".join(many)
            if kind < 0.6:
                out.append(rng.choice((f"<p>{s}</p>", f"<p>{s}</p>", f"<p>{s}", f"<p><b>{s}<br>", f"<div>{s}</div>", f'<p>{s} <a href="/y">{many[0]}</a></p>')))
            elif kind < 0.7:
                out.append(f"<h2>{many[0][:50]}</h2>")
            elif kind < 0.8:
                out.append("<ul>" + "".join(f"<li>{x}" for x in many) + "</ul>")
            elif kind < 0.87:
                out.append(f"<blockquote><p>{s}</p></blockquote>")
            elif kind < 0.92:
                out.append("<table>" + "".join(f"<tr><td>{x}<td>{self.rng.randrange(100)}" for x in many) + "</table>")
            elif kind < 0.96:
                out.append(f"<figure><img src=x><figcaption>{many[0]}</figcaption></figure>")
            else:
                out.append(f"<pre>{s}</pre>")
        return out

    def page(self) -> str:
        rng = self.rng
        body = self._article()
        for part in ("advert", "notice", "sidebar", "form", "comments"):
            if rng.random() < 0.2:
                body.insert(len(body) if part == "comments" else rng.randrange(len(body) + 1), self._part(part))
        middle = [self._within(rng.choice(ARTICLE), "".join(body), 1)]
        for part, chance in (("comments", 0.3), ("sidebar", 0.4), ("advert", 0.4), ("notice", 0.2), ("form", 0.25), ("menu", 0.2)):
            if rng.random() < chance:
                middle.insert(len(middle) if part == "comments" else rng.randrange(len(middle) + 1), self._part(part))
        for _ in range(rng.choice((0, 0, 1, 2))):
            k = rng.randrange(len(middle))
            middle = middle[:k] + [self._within(rng.choice(PLAIN), "".join(middle[k:]))]
        before = [self._part(p) for p, chance in (("header", 0.6), ("menu", 0.8), ("notice", 0.3), ("advert", 0.4)) if rng.random() < chance]
        rng.shuffle(before)
        after = [self._part(p) for p, chance in (("form", 0.15), ("footer", 0.85), ("notice", 0.15)) if rng.random() < chance]
        whole = "".join(before + middle + after)
        if rng.random() < 0.4:
            whole = self._within(rng.choice(PLAIN), whole)
        return f'<!DOCTYPE html><html><head><title>x</title></head><body data-keep="0">{whole}' + rng.choice(("</body></html>", ""))
