"""Section predicates.  Each is a Column, so a query can tell why a section is dropped; cheap ones come first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.config import BOILERPLATE_SECTION, BOILERPLATE_SUBTREE, TEMPLATE_HEADING
from docmill.functions import text as T
from docmill.functions.arrays import let

_RAW, _HEAD, _PATH = "heading_raw", "heading_text", "path"


def contains_any(c: Column, parts: tuple[str, ...]) -> Column:
    """One scan for all parts, which are plain words."""
    return c.rlike("|".join(parts))


def boilerplate(head: Column) -> Column:
    return F.coalesce(contains_any(T.heading_key(head), BOILERPLATE_SECTION), F.lit(False))


def boilerplate_subtree(path: Column) -> Column:
    return F.exists(F.slice(path, 1, F.greatest(F.size(path) - 1, F.lit(0))), lambda h: contains_any(T.heading_key(h), BOILERPLATE_SUBTREE))


def cross_reference(body: Column) -> Column:
    """Whether a text is ``Recommendation`` or ``Recommendations`` and numbers with joiners between them.

    What follows the word is cut at its numbers, so that a list of any length takes no stack, as a repeated group of a pattern would."""

    def listed(rest: Column) -> Column:
        between = F.split(rest, r"(?U)[\d.]+", -1)
        inner = F.slice(between, 2, F.greatest(F.size(between) - 2, F.lit(0)))
        joined = F.forall(inner, lambda x: F.lower(T.strip(x)).isin(",", "and", "to", "–", "-"))
        return (F.size(between) > 1) & (F.element_at(between, 1) == "") & (T.strip(F.element_at(between, -1)) == "") & joined

    # Only such a text is made plain.
    may_be = body.rlike(f"(?i){T.marked('recommendation')}") | body.contains("](")
    return may_be & let(F.regexp_extract(T.inline(body), r"(?iUs)^\s*Recommendations?\s+(.*)$", 1), listed)


def table_profile(body: Column) -> Column:
    """array<struct<row, bare, plain, cells, filled>> of the lines that aren't blank: whether a line is a table row, whether it
    is a separator (``bare``: as it stands; ``plain``: without tags), and its cells."""

    def line(s: Column) -> Column:
        row = s.startswith("|") & s.endswith("|")
        cells = F.when(row, F.transform(F.split(F.btrim(s, F.lit("|")), r"\|", -1), lambda c: T.strip(c)))
        return F.struct(row.alias("row"), cells.alias("cells"))

    def counted(x: Column) -> Column:
        plain = F.transform(x["cells"], lambda c: F.when(c.contains("<"), T.strip(T.untagged(c, ""))).otherwise(c))
        return F.struct(
            x["row"].alias("row"), F.forall(x["cells"], lambda c: c.rlike(r"^[-: ]+$")).alias("bare"), F.forall(plain, lambda c: c.rlike(r"^[-: ]+$")).alias("plain"),
            F.size(x["cells"]).alias("cells"), F.size(F.filter(plain, lambda c: c != "")).alias("filled"),
        )

    filled = F.filter(F.transform(T.lines(body), lambda s: T.rstrip(s)), lambda s: s != "")
    return F.transform(F.transform(filled, line), counted)


def blank_form(profile: Column) -> Column:
    """A pure table with over half of its data rows blank, or with none."""
    rows = F.size(F.filter(profile, lambda r: ~r["bare"]))
    blank = F.size(F.filter(profile, lambda r: ~r["bare"] & (r["filled"] == 0)))
    return (F.size(profile) > 0) & F.forall(profile, lambda r: r["row"]) & ((rows == 0) | (blank * 2 > rows))


def sparse_template(key: Column, profile: Column) -> Column:
    """A form-like heading over a table of five or more columns that is under 45 % filled."""
    table = F.filter(profile, lambda r: r["row"])
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("cells"), F.lit(0).alias("filled"), F.lit(0).alias("wide"))

    def add(acc: Column, r: Column) -> Column:
        return F.when(r["plain"], acc).otherwise(
            F.struct((acc["n"] + 1).alias("n"), (acc["cells"] + r["cells"]).alias("cells"), (acc["filled"] + r["filled"]).alias("filled"), F.greatest(acc["wide"], r["cells"]).alias("wide"))
        )

    sparse = F.aggregate(table, zero, add, lambda x: (x["n"] == 0) | (x["cells"] == 0) | ((x["wide"] >= 5) & (F.try_divide(x["filled"], x["cells"]) < 0.45)))
    return key.rlike(TEMPLATE_HEADING) & (F.size(table) >= 3) & (F.try_divide(F.size(table), F.size(profile)) >= 0.7) & sparse


def manual_index(heading: Column, plain: Column) -> Column:
    h = T.inline(F.coalesce(heading, F.lit("")))
    indexish = (h != "") & (h == F.upper(h)) & (F.length(h) <= 24)
    return (F.regexp_count(plain, F.lit(r"\b[A-Z]-\d+(?:[\-–]\d+)?\b")) >= 5) & (indexish | F.lower(plain).contains("see also"))


def contents_list(whole: Column, plain: Column) -> Column:
    def entry(s: Column) -> Column:
        return T.inline(s).rlike(r"(?U)\b\d+\s*$") | (T.strip(s).startswith("|") & s.rlike(r"(?U)\|\s*[\divxlcdmIVXLCDM]+\s*\|\s*$"))

    def enough(marks: Column) -> Column:
        n = F.size(marks)
        return (n >= 5) & (F.size(F.filter(marks, lambda m: m)) >= F.greatest(F.lit(4), F.floor(n / 2)))

    lines = F.filter(T.lines(whole), lambda s: T.strip(s) != "")
    # An entry ends with a digit or a bar, or with a link or a tag, marks aside: few sections have four such lines, and only these are looked
    # at line by line.
    ends = r"(?U)[\p{Nd}|)>][*_`~\s]*(?:[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]|\z)"
    listed = F.when(F.regexp_count(whole, F.lit(ends)) >= 4, let(F.transform(lines, entry), enough)).otherwise(False)
    return F.lower(plain).contains("table of contents") | listed


def explained(sections: DataFrame) -> DataFrame:
    """Adds ``reason``: the first predicate that drops a section, null where it is kept.

    Cheap predicates come first, and what several costly ones share is a column of its own, computed once and only for
    sections that are still in."""
    body, head, path = F.col("body"), F.col(_HEAD), F.col(_PATH)
    cheap = F.when(boilerplate(head), "boilerplate").when(boilerplate_subtree(path), "subtree").when(T.strip(body) == "", "empty").when(cross_reference(body), "cross_reference")
    rows = sections.withColumn("_cheap", cheap)
    alive = F.col("_cheap").isNull()
    whole = T.rendered(F.col(_RAW), body)
    key = T.heading_key(F.when(F.size(path) > 0, F.array_join(path, " ")).otherwise(F.coalesce(head, F.lit(""))))
    rows = rows.withColumn("_whole", F.when(alive, whole)).withColumn("_profile", F.when(alive & body.contains("|"), table_profile(body)))
    # The plain text is made only where an index entry or the words of a contents list may be in it.
    wanted = F.col("_whole").rlike(f"[A-Z][*_`~]*-[*_`~]*\\p{{Nd}}|(?i){T.marked('contents')}") | F.col("_whole").contains("](")
    rows = rows.withColumn("_plain", F.when(wanted, T.inline(F.col("_whole"))).otherwise(""))
    costly = (
        F.when(blank_form(F.col("_profile")), "blank_form").when(F.when(F.col("_profile").isNotNull(), sparse_template(key, F.col("_profile"))), "sparse_template")
        .when(manual_index(head, F.col("_plain")), "manual_index").when(contents_list(F.col("_whole"), F.col("_plain")), "contents_list")
    )
    return rows.withColumn("reason", F.coalesce("_cheap", F.when(alive, costly))).drop("_cheap", "_whole", "_profile", "_plain")


def kept(sections: DataFrame) -> DataFrame:
    # A generator, so that the filter isn't pushed, expanded, through the projections that make the reason.
    return explained(sections).withColumn("reason", F.explode(F.array("reason"))).where("reason IS NULL").drop("reason")
