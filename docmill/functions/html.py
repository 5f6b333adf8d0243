"""HTML as balanced events: a tokeniser with a stack of open elements, in time linear in the text.

``walk`` yields (OPEN, name, attributes), (CLOSE, name, None) and (TEXT, text, None).  Elements whose end tag is missing are closed where the next
one of their kind, or the end of their parent, implies it; end tags without an element are ignored; void elements open and close at once.
Comments and declarations are dropped, character references are decoded, the content of ``RAW`` elements is one text.  A tag or an
attribute that the text ends in is dropped, as browsers do.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

OPEN, CLOSE, TEXT = 1, 2, 3

# Names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
RAW_WITH_REFERENCES = frozenset(("title", "textarea"))
_CLOSES_P = "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li dd dt main menu nav ol p pre search section summary table ul"
#: What an opening tag ends: the nearest open element of ``targets``, unless one of ``limits`` is nearer.
_IMPLIED = (
    # targets, limits, opening tags
    ("p", "button caption html object table td template th", _CLOSES_P),
    ("li", "ul ol menu table td th template button object", "li"),
    ("dd dt", "dl table td th template button object", "dd dt"),
    ("option", "select datalist optgroup template", "option optgroup"),
    ("optgroup", "select template", "optgroup"),
    ("td th", "table template", "td th tr tbody thead tfoot"),
    ("tr", "table template", "tr tbody thead tfoot"),
    ("tbody thead tfoot caption colgroup", "table template", "tbody thead tfoot"),
)
_ROLE: dict[str, list[tuple[int, bool]]] = defaultdict(list)
_ENDS: dict[str, list[int]] = defaultdict(list)
for _g, (_targets, _limits, _openers) in enumerate(_IMPLIED):
    for _name in _targets.split():
        _ROLE[_name].append((_g, True))
    for _name in _limits.split():
        _ROLE[_name].append((_g, False))
    for _name in _openers.split():
        _ENDS[_name].append(_g)
#: An end tag doesn't reach through these.
_SCOPE = frozenset("table td th caption html object template".split())

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)?\s*(=?)\s*")
_BARE = re.compile(r"[^\s>]*")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW | RAW_WITH_REFERENCES}


def _attributes(html: str, at: int) -> tuple[dict[str, str], int]:
    """(attributes, place after the tag's ``>``); the place is -1 where the text ends within the tag."""
    found: dict[str, str] = {}
    n = len(html)
    while True:
        m = _ATTRIBUTE.match(html, at)
        at = m.end()
        value = ""
        if at >= n:
            return found, -1
        if m.group(2) and html[at] in "\"'":
            end = html.find(html[at], at + 1)
            if end < 0:
                return found, -1
            value, at = unescape(html[at + 1 : end]), end + 1
        elif m.group(2):
            bare = _BARE.match(html, at)
            value, at = unescape(bare.group()), bare.end()
        if m.group(1):
            found.setdefault(m.group(1).lower(), value)
        if at < n and html[at] == ">":
            return found, at + 1


def tokens(html: str) -> Iterator[tuple[int, str, dict[str, str] | None]]:
    """The text's tags and texts as they stand."""
    at, n = 0, len(html)
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            yield TEXT, unescape(html[at:]), None
            return
        if lt > at:
            yield TEXT, unescape(html[at:lt]), None
        closing = html.startswith("/", lt + 1)
        name = _NAME.match(html, lt + 1 + closing)
        if name:
            word = name.group().lower()
            attributes, at = ({}, name.end() + 1) if html.startswith(">", name.end()) else _attributes(html, name.end())
            if at < 0:
                return
            yield (CLOSE, word, None) if closing else (OPEN, word, attributes)
            if not closing and word in _RAW_END:
                end = _RAW_END[word].search(html, at)
                stop = end.start() if end else n
                if stop > at:
                    yield TEXT, unescape(html[at:stop]) if word in RAW_WITH_REFERENCES else html[at:stop], None
                at = stop
        elif html.startswith("<!--", lt):
            if html.startswith((">", "->"), lt + 4):
                at = html.index(">", lt) + 1
            else:
                end = html.find("-->", lt + 4)
                at = end + 3 if end >= 0 else n
        elif closing or html.startswith(("!", "?"), lt + 1):
            end = html.find(">", lt + 1)
            at = end + 1 if end >= 0 else n
        else:
            yield TEXT, "<", None
            at = lt + 1


def walk(html: str) -> Iterator[tuple[int, str, dict[str, str] | None]]:
    """Balanced events of a page or a part of one."""
    stack: list[str] = []
    places: dict[str, list[int]] = defaultdict(list)
    marks: list[list[tuple[int, bool]]] = [[] for _ in _IMPLIED]  # of each rule, places of open targets and limits
    blocks: list[int] = []
    scopes: list[int] = []

    def pop(to: int) -> Iterator[tuple[int, str, None]]:
        while len(stack) > to:
            name, k = stack.pop(), len(stack)
            places[name].pop()
            for g, _ in _ROLE.get(name, ()):
                marks[g].pop()
            if blocks and blocks[-1] == k:
                blocks.pop()
            if scopes and scopes[-1] == k:
                scopes.pop()
            yield CLOSE, name, None

    for kind, value, attributes in tokens(html):
        if kind == TEXT:
            yield kind, value, None
        elif kind == OPEN:
            for g in _ENDS.get(value, ()):
                if marks[g] and marks[g][-1][1]:
                    yield from pop(marks[g][-1][0])
            yield OPEN, value, attributes
            if value in VOID:
                yield CLOSE, value, None
                continue
            k = len(stack)
            stack.append(value)
            places[value].append(k)
            for g, target in _ROLE.get(value, ()):
                marks[g].append((k, target))
            if value not in INLINE:
                blocks.append(k)
            if value in _SCOPE:
                scopes.append(k)
        elif places.get(value):
            k = places[value][-1]
            if value in INLINE:
                if not blocks or blocks[-1] < k:
                    yield from pop(k)
            elif value in _SCOPE or not scopes or scopes[-1] < k:
                yield from pop(k)
    yield from pop(0)
