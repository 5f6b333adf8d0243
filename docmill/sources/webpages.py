"""Web pages to markdown, a row of errors included: the extraction worker.

``to_markdown`` folds a page's balanced events (``functions.html``) into blocks; ``extract`` runs it in tasks over pages."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.functions.html import CLOSE, INLINE, OPEN, TEXT, walk

#: Elements whose content isn't text of the page.
DROPPED = frozenset("head script style template noscript nav footer svg math object iframe canvas select textarea button form".split())
#: Levels of lists and quotations that are marked; what nests deeper keeps the last one's, as its marks would grow with the square of the depth.
DEEP = 24
_MARKS = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`", "kbd": "`", "samp": "`", "del": "~~", "s": "~~", "strike": "~~"}
_HEADS = {f"h{k}": "#" * k for k in range(1, 7)}
EXTRACTED = "source string, markdown string, error string"


class _Page:
    """Blocks as they are met; an element that makes inline text of its own keeps it in a buffer until it ends."""

    def __init__(self, base: str):
        self.base = base
        self.blocks: list[str] = []
        self.buffers: list[list[str]] = [[]]
        self.lists: list[list] = []  # [ordered, number of the last item]
        self.items: list[int] = []  # of open items, the blocks that were there before
        self.quotes: list[int] = []
        self.tables: list[list[list[str]]] = []
        self.links: list[tuple[str, list[str]]] = []
        self.dropped = self.pre = 0
        self.head = ""

    def text(self, s: str) -> None:
        self.buffers[-1].append(s)

    def line(self) -> str:
        """The buffer's text, emptied: white space in single spaces, a line break where the page has one."""
        buffer = self.buffers[-1]
        whole = "".join(buffer)
        buffer.clear()
        return "\n".join(x for x in (" ".join(part.split()) for part in whole.split("\x00")) if x)

    def flush(self) -> None:
        if self.tables:  # within a table only cells make text
            return
        text = self.line()
        if text:
            self.blocks.append(f"{self.head} {' '.join(text.split())}" if self.head else text)


def to_markdown(html: str, base: str = "") -> str:
    """Markdown of a page: headings, paragraphs, nested lists, tables, quotations, code blocks, links, images and emphasis.

    Blocks are parted by an empty line, items of a list by a line break; a table's first row is its header and short rows are filled up."""
    p = _Page(base)
    open_marks: list[str] = []
    for kind, value, attributes in walk(html):
        if p.dropped or (kind != TEXT and value in DROPPED):
            p.dropped += (kind == OPEN and value in DROPPED) - (kind == CLOSE and value in DROPPED)
            if kind == OPEN and p.dropped == 1:
                p.flush()
            continue
        if kind == TEXT:
            if value:
                p.text(value if p.pre else value.replace("\x00", " "))
        elif value == "br":
            if kind == OPEN:
                p.text("\n" if p.pre else "\x00")
        elif value == "img":
            if kind == OPEN and attributes.get("src"):
                p.text(f"![{' '.join(attributes.get('alt', '').split())}]({urljoin(base, attributes['src'])})")
        elif value == "a":
            if kind == OPEN:
                p.links.append((attributes.get("href", ""), []))
                p.buffers.append([])
            elif p.links:
                target, _ = p.links.pop()
                label = " ".join("".join(p.buffers.pop()).replace("\x00", " ").split())
                p.text(f"[{label}]({urljoin(base, target)})" if label and target else label)
        elif value in _MARKS and not p.pre:
            if kind == OPEN:
                open_marks.append(value)
                p.buffers.append([])
            elif open_marks:
                open_marks.pop()
                inner = "".join(p.buffers.pop())
                core = inner.strip()
                mark = _MARKS[value]
                p.text(inner.replace(core, f"{mark}{core}{mark}", 1) if core and "\x00" not in core else inner)
        elif value in INLINE:
            pass
        else:
            _block(p, kind, value)
    p.flush()
    return "\n\n".join(p.blocks)


def _block(p: _Page, kind: int, name: str) -> None:
    """An element that begins or ends a block."""
    if p.tables or name == "table":
        _table(p, kind, name)
        return
    if len(p.buffers) > 1:  # a block within a link or a mark: its words go on in the text
        p.text(" ")
        return
    if name == "pre":
        if kind == OPEN:
            p.flush()
            p.pre += 1
        else:
            p.pre -= 1
            text = "".join(p.buffers[-1]).strip("\n")
            p.buffers[-1].clear()
            if text.strip():
                fence = "```" + "`" * (3 if "```" in text else 0)
                p.blocks.append(f"{fence}\n{text}\n{fence}")
        return
    p.flush()
    if name in _HEADS:
        p.head = _HEADS[name] if kind == OPEN else ""
    elif name in ("ul", "ol", "menu"):
        if kind == OPEN:
            p.lists.append([name == "ol", 0])
        else:
            p.lists.pop()
    elif name == "li":
        if kind == OPEN:
            if p.lists:
                p.lists[-1][1] += 1
            p.items.append(len(p.blocks))
        else:
            at = p.items.pop()
            ordered, number = p.lists[-1] if p.lists else (False, 0)
            marker = f"{number}. " if ordered else "- "
            own = "\n".join(p.blocks[at:])
            del p.blocks[at:]
            if own:
                item = marker + (own.replace("\n", "\n" + " " * len(marker)) if len(p.items) < DEEP else own)
                if p.lists and number > 1 and p.blocks and len(p.blocks) > (p.items[-1] if p.items else 0) and p.blocks[-1].startswith(("- ", "1. ")):
                    p.blocks[-1] += "\n" + item
                else:
                    p.blocks.append(item)
    elif name == "blockquote":
        if kind == OPEN:
            p.quotes.append(len(p.blocks))
        else:
            at = p.quotes.pop()
            own = "\n\n".join(p.blocks[at:])
            del p.blocks[at:]
            if own:
                p.blocks.append("\n".join(f"> {x}".rstrip() for x in own.split("\n")) if len(p.quotes) < DEEP else own)
    elif name == "hr" and kind == OPEN:
        p.blocks.append("---")


def _table(p: _Page, kind: int, name: str) -> None:
    if name == "table":
        if kind == OPEN:
            if p.tables:
                p.text(" ")
            else:
                p.flush()
            p.tables.append([])
            p.buffers.append([])
            return
        rows = [r for r in p.tables.pop() if any(r)]
        p.buffers.pop()
        if p.tables:  # a table within a cell: its cells are words of that cell
            p.text(" ".join(c for r in rows for c in r if c) + " ")
        elif rows:
            width = max(map(len, rows))
            shown = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in rows]
            p.blocks.append("\n".join([shown[0], "|" + "---|" * width, *shown[1:]]))
    elif name == "tr" and kind == OPEN:
        p.tables[-1].append([])
    elif name in ("td", "th"):
        if kind == OPEN:
            p.buffers.append([])
        else:
            cell = " ".join("".join(p.buffers.pop()).replace("\x00", " ").split()).replace("|", "\\|")
            if not p.tables[-1]:
                p.tables[-1].append([])
            p.tables[-1][-1].append(cell)
    else:
        p.text(" ")


def extract(pages: DataFrame, source: str = "source", html: str = "html", base: str | None = None) -> DataFrame:
    """(source, markdown, error) of each page; a page that fails has its error and no markdown, and stops no other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made, errors = [], []
            for text, at in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                try:
                    made.append(to_markdown(text, at or ""))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  any failure is that page's
                    made.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.string()), pa.array(errors, pa.string())], ["source", "markdown", "error"])

    at = F.col(base) if base else F.lit("")
    return pages.select(F.col(source).cast("string").alias("source"), F.col(html).cast("string").alias("html"), at.cast("string").alias("base")).mapInArrow(run, EXTRACTED)
