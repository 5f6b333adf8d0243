"""Scalar text functions as Column builders; all stay in the JVM.

``\\s`` and ``\\d`` are Unicode-aware (``(?U)``), as ``strip`` is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmill.functions.arrays import let, scan

LINE_BREAK = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"
OTHER_BREAK = "[\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"
PAGE_MARKER = r"(?U)^\s*<!--\s*page:\s*(\d+)\s*-->"
ATX = r"(?U)^(#{1,6})\s+(.*\S)\s*$"
BOLD = r"^\*\*(.+?)\*\*$"
LIST_ITEM = r"(?U)^\s*(?:[-*+]\s+|\d+[.)]\s+)"


def sub(c: Column, pattern: str, to: str) -> Column:
    return F.regexp_replace(c, pattern, to)


#: What counts as white space at the ends of a text.
SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(SPACE))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(SPACE))


def lines(c: Column) -> Column:
    """Physical lines; a final line break makes no empty last line."""

    def without_last(parts: Column) -> Column:
        return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))).otherwise(parts)

    return let(F.when(c.rlike(OTHER_BREAK), F.split(c, LINE_BREAK, -1)).otherwise(F.split(c, "\n", -1)), without_last)


def within(c: Column, last: str, change: Callable[[Column], Column]) -> Column:
    """``change`` of the text up to the last ``last``, and the rest as it is.

    For patterns whose matches end with ``last``: in what is left to search every attempt meets an end, so that texts of many beginnings
    without an end don't take quadratic time."""

    def parts(tail: Column) -> Column:
        return F.concat(change(F.substring(c, F.lit(1), F.length(c) - F.length(tail))), tail)

    return let(F.substring_index(c, last, -1), parts)


def untagged(c: Column, to: str) -> Column:
    """Every ``<...>`` replaced; a ``<`` without an end, and ``<>``, stay."""
    return F.when(c.contains("<"), within(c, ">", lambda x: sub(x, "<[^>]++>", to))).otherwise(c)


def unlinked(c: Column, target: str = "[^)]++") -> Column:
    """``[label](target)`` replaced by its label.

    Brackets before one ``]`` share their fate, so where the first isn't a link's, all up to there is passed over at once."""
    link = rf"\[([^\]]++)\]\({target}\)|(\[[^\]]*+(?:\]|\z))"
    return F.when(c.contains("]("), within(c, ")", lambda x: sub(x, link, "$1$2"))).otherwise(c)


def strip_spans(c: Column) -> Column:
    """Without empty span elements.  A span that isn't empty is passed over up to its ``>``."""
    return F.when(c.contains("<span"), within(c, ">", lambda x: sub(x, "(<span[^>]*+>)(?!</span>)|<span[^>]*+></span>", "$1"))).otherwise(c)


def span_count(c: Column) -> Column:
    """How many empty span elements there are."""
    ended = F.substring(c, F.lit(1), F.length(c) - F.length(F.substring_index(c, ">", -1)))
    spans = F.regexp_extract_all(ended, F.lit("<span[^>]*+>(?:</span>)?"), F.lit(0))
    return F.when(c.contains("<span"), F.size(F.filter(spans, lambda m: m.endswith("></span>")))).otherwise(F.when(c.isNotNull(), 0)).cast("bigint")


def without_superscripts(c: Column) -> Column:
    """Without ``sup`` elements, the nearest end tag being their end."""

    def parts(head: Column) -> Column:
        return F.concat(sub(head, r"(?is)<sup[^>]*+>.*?</sup>|(<sup[^>]*+>)", "$1"), F.substring(c, F.length(head) + 1, F.length(c)))

    return F.when(c.rlike("(?i)<sup"), let(F.regexp_extract(c, "(?is)^.*</sup>", 0), parts)).otherwise(c)


def page_marker_line(c: Column) -> Column:
    """``{n}`` and 48 dashes becomes the marker of page n + 1; other lines stay."""
    n = F.regexp_extract(c, r"^\{(\d+)\}-{48}$", 1)
    return F.when(n != "", F.format_string("<!-- page: %d -->", n.try_cast("bigint") + 1)).otherwise(c)


def inline(c: Column) -> Column:
    """Plain text of inline markdown."""

    plain = let(let(c, lambda x: unlinked(x)), lambda x: untagged(x, " "))
    return F.trim(sub(F.translate(plain, "*_`~", ""), r"(?U)\s+", " "))


def marked(word: str) -> str:
    """Pattern of a word that may have inline marks, which are dropped, between its letters."""
    return "[*_`~]*".join(word)


def may_be_footer(c: Column) -> Column:
    """A cheap test that every text with a footer passes."""
    low, marks = F.lower(c), c.contains("*") | c.contains("_") | c.contains("`") | c.contains("~")
    return low.contains("revision") | low.contains("page") | (marks & c.rlike(f"(?i){marked('revision')}|{marked('page')}")) | c.contains("](")


def footer(c: Column) -> Column:
    """Whether a line is a page footer."""
    plain = F.lower(inline(F.replace(c, F.lit("|"), F.lit(" "))))
    return let(plain, lambda p: p.startswith("revision no.") | p.rlike(r"(?U)^page\s+[ivxlcdm\d]+\s+of\s+\d+$"))


def table_artifact(c: Column) -> Column:
    """Whether a line is blank or what is left of an empty table row."""

    def empty(s: Column) -> Column:
        row = s.startswith("|") & s.endswith("|")
        return (s == "") | s.rlike(r"(?U)^\|?[-:\s|]+\|?$") | (row & F.forall(F.split(F.btrim(s, F.lit("|")), r"\|", -1), lambda x: strip(x) == ""))

    return let(strip(c), empty)


def strip_footers(c: Column) -> Column:
    """Drop footer lines and the artefact lines right after each; at most one blank line in a row; stripped."""

    def kept(all_lines: Column) -> Column:
        # 1 for a footer, 0 for text; an artefact (null) goes if the last line that is neither was a footer.
        state = F.transform(all_lines, lambda s: F.when(may_be_footer(s) & footer(s), 1).when(~table_artifact(s), 0))
        after = scan(state, lambda before, own: F.coalesce(own, before))
        return let(after, lambda a: F.array_join(F.filter(all_lines, lambda s, i: F.coalesce(F.get(a, i), F.lit(0)) == 0), "\n"))

    def without(x: Column) -> Column:
        # Line by line only where a line may be a footer.
        return F.when(may_be_footer(x), let(lines(x), kept)).when(x.rlike(OTHER_BREAK), F.array_join(lines(x), "\n")).otherwise(x)

    return strip(let(let(c, without), lambda x: F.when(x.contains("\n\n\n"), sub(x, "\n{3,}", "\n\n")).otherwise(x)))


def clean(c: Column) -> Column:
    """Text of a passage without HTML, dead links, footers and runs of spaces."""

    def plain(x: Column) -> Column:
        broken = let(without_superscripts(x), lambda y: sub(y, r"(?iU)<br\s*/?>", " "))
        return F.when(x.contains("<"), let(broken, lambda y: untagged(y, ""))).otherwise(x)

    whole = strip_footers(let(let(c, plain), lambda x: unlinked(x, "#[^)]*+")))
    return let(whole, lambda t: F.when(t.contains("  ") | t.contains("\t"), sub(t, r"[ \t]{2,}", " ")).otherwise(t))


def heading_key(c: Column) -> Column:
    """Normalised heading for matching."""
    return F.lower(F.btrim(inline(c), F.lit(": ")))


def is_table_line(c: Column) -> Column:
    s = strip(c)
    return s.startswith("|") & s.endswith("|")


def line_class(c: Column) -> Column:
    return F.when(strip(c) == "", "blank").when(is_table_line(c), "table").when(c.rlike(LIST_ITEM), "list").otherwise("paragraph")


def heading_like(c: Column) -> Column:
    t = inline(c)
    words = F.size(F.split(t, " "))
    return (t != "") & (F.length(t) <= 160) & ~t.rlike(r"[.;?!]$") & words.between(3, 18)


def heading(c: Column) -> Column:
    """struct<level int, raw string, text string> of a heading line, else null."""
    s = strip(c)
    marks, bold = F.regexp_extract(s, ATX, 1), F.regexp_extract(s, BOLD, 1)

    def made(level: Column, text: Column) -> Column:
        return F.struct(level.cast("int").alias("level"), s.alias("raw"), inline(text).alias("text"))

    return F.when(marks != "", made(F.length(marks), F.regexp_extract(s, ATX, 2))).when((bold != "") & heading_like(bold), made(F.lit(3), bold))


def rendered(raw: Column, body: Column) -> Column:
    return strip(F.concat_ws("\n\n", raw, F.when(strip(body) != "", strip(body))))


def breadcrumb(path: Column) -> Column:
    """``> A > B`` of the ancestors, null without any."""
    return F.when(F.size(path) > 1, F.concat(F.lit("> "), F.array_join(F.slice(path, 1, F.size(path) - 1), " > ")))


def normalized_id(c: Column) -> Column:
    return F.btrim(sub(sub(c, r"[^A-Za-z0-9\-.]", "_"), "_+", "_"), F.lit("_"))


def label(c: Column) -> Column:
    """``SOURCE:...`` of a prefixed passage."""
    return F.regexp_extract(c, r"^\[(SOURCE:[^\]]*)\]", 1)
