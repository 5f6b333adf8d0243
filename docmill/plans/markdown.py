"""Derived markdown over the driver's documents, which have no structure: a deterministic line decoration.

``DECORATION`` is a CASE over one line that Spark and DuckDB both read: ``x`` the line, ``d`` the doc_id, ``r`` the template number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_S, _D, _N = "replace(substr(x, 1, 40), '|', ' ')", "cast(d AS string)", "chr(10)"


def _t(*parts: str) -> str:
    return " || ".join({"S": _S, "D": _D, "N": _N}.get(p, "'" + p + "'") for p in parts)


_MORE = ["N", "## Continued ", "D"]
TEMPLATES = {
    1: _t("# ", "S"), 2: _t("## ", "S"), 3: _t("### ", "S"), 4: _t("**Ward round notes ", "D", "**"), 5: _t("- ", "S", "N", "- second item", "N", "  wrapped text"),
    6: _t("| Drug | Dose |", "N", "|---|---|", "N", "| ", "S", " | 5 mg |", "N", "| other | 10 mg |"), 7: "'<!-- page: ' || cast(1 + cast(floor(ln / 4) AS int) AS string) || ' -->'",
    8: _t("Revision No. 3", "N", "|---|---|", "N", "| | |"), 9: _t("## Acknowledgements", "N", "S", "N", "### Thanks group ", "D", "N", "S", *_MORE),
    10: _t("## Onward links", "N", "Recommendations 1.2.15 to 1.2.22", *_MORE), 11: _t("## Facility details", "N", "|  |  |", "N", "|---|---|", "N", "|  |  |", "N", "| a |  |", *_MORE),
    12: _t("## Referral form", "N", "| A | B | C | D | E |", "N", "|---|---|---|---|---|", "N", "| x | | | | |", "N", "| y | | | | |", "N", "| z | | | | |", *_MORE),
    13: _t("## AB", "N", "Fever, A-1, B-22, C-3", "N", "Cough, see also D-5, E-6", *_MORE),
    14: _t("## Chapter list", "N", "Intro 1", "N", "Care 12", "N", "Birth 30", "N", "After 41", "N", "Drugs 55", *_MORE), 15: _t("## Empty ", "D", "N", "## Full ", "D"),
    16: _S + " || '<sup>3</sup> see [part](#a)<br>now <b>bold</b>  twice'", 17: _t('# <span id="p1"></span>', "S"), 18: "''",
    19: f"repeat({_S} || ' plain sentence. ', 60)", 20: f"'- item ' || {_S} || repeat({_N} || '- item ' || {_S}, 39)",
    21: f"'| K | V |' || {_N} || '|---|---|' || repeat({_N} || '| ' || {_S} || ' | v mg |', 40)",
    22: "'# Standard precautions' || chr(10) || repeat('Wash hands before and after every contact and record the time. ', 2) || chr(10) || '## After ' || " + _D,
}
# Templates hold the first 40 characters of a line, if any; what they leave out follows as a line of its own.
_HELD = "CASE WHEN r IN (4, 7, 8, 10, 11, 12, 13, 14, 15, 18) THEN 0 WHEN r BETWEEN 1 AND 22 THEN 40 ELSE length(x) END"
DECORATION = "CASE r " + " ".join(f"WHEN {r} THEN {t}" for r, t in TEMPLATES.items()) + f" ELSE x END || CASE WHEN length(x) > {_HELD} THEN chr(10) || substr(x, {_HELD} + 1) ELSE '' END"


def decorated(docs: DataFrame) -> DataFrame:
    """(source, text): markdown of each document, made line by line where it lies; source is its doc_id."""
    whole = docs.where("text IS NOT NULL").select(F.col("doc_id").alias("d"), F.split("text", "\n", -1).alias("_lines"))
    made = F.expr(f"zip_with(_lines, sequence(1, size(_lines)), (x, ln) -> transform(array((d * 7 + ln * 5) % 24), r -> {DECORATION})[0])")
    return whole.select(F.col("d").alias("source"), F.array_join(made, "\n").alias("text"))


def from_html(pages: DataFrame) -> DataFrame:
    """(source, text): markdown of web pages; headings, list items and paragraphs, without scripts, styles and chrome."""
    h = F.col("html")
    for tag in ("script", "style", "nav", "footer"):
        h = F.regexp_replace(h, f"(?is)<{tag}[^>]*>.*?</{tag}>", "")
    h = F.regexp_replace(F.regexp_replace(h, "(?s)<!--.*?-->", ""), r"(?i)<h1[^>]*>", "\n# ")
    h = F.regexp_replace(F.regexp_replace(h, r"(?i)<li[^>]*>", "\n- "), r"(?i)<(?:p|/p|/h1|/li|br)\s*/?[^>]*>", "\n")
    return pages.select(F.col("page_id").alias("source"), F.regexp_replace(F.regexp_replace(h, "<[^>]+>", ""), r"[ \t]+", " ").alias("text"))
