"""Heading-aware sections, of numbered lines or of whole documents.

``sections`` works on rows of lines: all its windows and aggregations share one partitioning on ``source``, one shuffle.  ``folded`` works on
documents and shuffles nothing: Spark's functions find page markers and headings, and an Arrow pass cuts the text at them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from docmill.functions import text as T

MAX_LEVEL = 6


def source_name(rows: DataFrame) -> Column:
    """The name in ``source``, which may be a (corpus_rank, source) pair."""
    return F.col("source.source") if isinstance(rows.schema["source"].dataType, StructType) else F.col("source")


def assigned(lines: DataFrame) -> DataFrame:
    """Adds ``ordinal``: how many headings stand at or before a line (0: before the first)."""
    upto = Window.partitionBy("source").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("ordinal", F.sum(F.col("heading").isNotNull().cast("int")).over(upto))


def paths(sections: DataFrame) -> DataFrame:
    """Adds ``path``: headings from the outermost ancestor to the section's own."""
    upto = Window.partitionBy("source").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, 0)
    level = F.col("heading.level")
    for k in range(1, MAX_LEVEL + 1):
        sections = sections.withColumn(f"_{k}", F.last(F.when(level == k, F.struct("ordinal", "heading.text")), ignorenulls=True).over(upto))
    # The last heading of level k is an ancestor unless a higher one came after it.
    own = []
    for k in range(1, MAX_LEVEL + 1):
        newer = F.lit(True)
        for j in range(1, k):
            newer = newer & (F.col(f"_{k}.ordinal") > F.coalesce(F.col(f"_{j}.ordinal"), F.lit(-1)))
        own.append(F.when((level >= k) & newer, F.col(f"_{k}.text")))
    return sections.withColumn("path", F.array_compact(F.array(*own))).drop(*[f"_{k}" for k in range(1, MAX_LEVEL + 1)])


def sections(lines: DataFrame) -> DataFrame:
    """(source, section_no, section_id, level, heading_raw, heading_text, path, page_start, page_end, body, lines).

    ``lines`` is array<struct<line_no, line, page>> of the body.  A section survives with a heading or any text; numbers are
    dense over the survivors of a source."""
    filled = F.col("heading").isNull() & (T.strip(F.col("line")) != "")
    grouped = assigned(lines).groupBy("source", "ordinal").agg(
        F.max("heading").alias("heading"),
        F.max(F.when(F.col("heading").isNotNull(), F.col("page"))).alias("_head_page"),
        F.min(F.when(filled, F.struct("line_no", "page"))).alias("_first"),
        F.max(F.when(filled, F.struct("line_no", "page"))).alias("_last"),
        F.array_sort(F.collect_list(F.when(F.col("heading").isNull(), F.struct("line_no", "line", "page")))).alias("lines"),
    )
    alive = paths(grouped.where(F.col("heading").isNotNull() | F.col("_first").isNotNull()))
    start = F.coalesce("_head_page", "_first.page")
    number = F.row_number().over(Window.partitionBy("source").orderBy("ordinal"))
    return alive.withColumn("section_no", number).select(
        "source", "section_no", F.format_string("%s:section:%04d", source_name(alive).cast("string"), F.col("section_no")).alias("section_id"), F.col("heading.level").alias("level"),
        F.col("heading.raw").alias("heading_raw"), F.col("heading.text").alias("heading_text"), "path", start.alias("page_start"), F.coalesce("_last.page", start).alias("page_end"),
        T.strip(F.array_join("lines.line", "\n")).alias("body"), "lines",
    )


_FOLDED = """section_no int, level int, heading_raw string, heading_text string, path array<string>, page_start int, page_end int, rows string, turns array<struct<at:int,page:int>>"""
#: Sections, or code points of them, that leave a fold at once.
BATCH, BATCH_CHARS = 512, 1 << 20


def marked(lines: Column) -> Column:
    """array<struct<at, page, head>>: those of the lines (from 0) that are page markers or headings."""

    def mark(line: Column, at: Column) -> Column:
        number = F.regexp_extract(line, T.PAGE_MARKER, 1)
        page = F.when(number != "", number.try_cast("int"))
        found = F.struct(at.alias("at"), page.alias("page"), F.when(page.isNull(), T.heading(line)).alias("head"))
        return F.when(line.contains("#") | line.contains("**") | line.contains("<!--"), found)

    return F.filter(F.transform(lines, mark), lambda m: m["page"].isNotNull() | m["head"].isNotNull())


def cut(text: str, marks: list[dict]) -> Iterator[dict]:
    """Sections of one text: those with a heading or with words.

    ``rows`` are a body's lines without marker lines; ``turns`` say from which of them on a page holds."""
    lines = text.split("\n")
    page, above = 1, []
    begun = {"head": None, "path": [], "page": None, "rows": [], "turns": []}

    def closed(s: dict) -> Iterator[dict]:
        pages = [t["page"] for t in s["turns"] if any(x.strip() for x in s["rows"][t["at"] : t["end"]])]
        if s["head"] or pages:
            head = s["head"] or {"level": None, "raw": None, "text": None}
            start = s["page"] if s["page"] is not None else pages[0]
            yield {
                "level": head["level"], "heading_raw": head["raw"], "heading_text": head["text"], "path": s["path"], "page_start": start, "page_end": pages[-1] if pages else start,
                "rows": "\n".join(s["rows"]), "turns": [{"at": t["at"], "page": t["page"]} for t in s["turns"]],
            }

    at = 0
    for mark in [*marks, {"at": len(lines), "page": None, "head": None}]:
        if mark["at"] > at:
            n = len(begun["rows"])
            begun["rows"] += lines[at : mark["at"]]
            begun["turns"].append({"at": n, "end": len(begun["rows"]), "page": page})
        at = mark["at"] + 1
        if mark["page"] is not None:
            page = mark["page"]
        elif mark["head"]:
            yield from closed(begun)
            above = [h for h in above if h["level"] < mark["head"]["level"]] + [mark["head"]]
            begun = {"head": mark["head"], "path": [h["text"] for h in above], "page": page, "rows": [], "turns": []}
    yield from closed(begun)


def folded(docs: DataFrame) -> DataFrame:
    """(source, ..., section_no, section_id, level, heading_raw, heading_text, path, page_start, page_end, body, rows, turns) of (source, text, ...).

    Each document is cut by itself, in its place; numbers are dense within it.  Documents of one name, or of none, stay apart."""
    keep = [c for c in docs.columns if c != "text"]
    schema = StructType([docs.schema[c] for c in keep] + [StructField(f.name, f.dataType) for f in StructType.fromDDL(_FOLDED)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        for b in batches:
            held, of, chars = [], [], 0

            def out() -> pa.RecordBatch:
                made = pa.Table.from_pylist(held, schema=kind).to_batches()[0]
                place = pa.array(of, pa.int64())
                return pa.RecordBatch.from_arrays([b.column(i).take(place) for i in range(len(keep))] + made.columns, [*keep, *kind.names])

            kind = kind or pa.schema(
                [("section_no", pa.int32()), ("level", pa.int32()), ("heading_raw", pa.string()), ("heading_text", pa.string()), ("path", pa.list_(pa.string())), ("page_start", pa.int32()), ("page_end", pa.int32()), ("rows", pa.string())]
                + [("turns", pa.list_(pa.struct([("at", pa.int32()), ("page", pa.int32())])))]
            )
            for row in range(b.num_rows):
                text, marks = b.column(len(keep))[row].as_py(), b.column(len(keep) + 1)[row].as_py()
                for n, s in enumerate(cut(text, marks) if text is not None else (), 1):
                    held.append(s | {"section_no": n})
                    of.append(row)
                    chars += len(s["rows"])
                    if len(held) == BATCH or chars > BATCH_CHARS:
                        yield out()
                        held, of, chars = [], [], 0
            if held:
                yield out()

    # A column of its own, so that lines are found once.
    lines = docs.select(*keep, T.lines(T.strip_spans(F.col("text"))).alias("_lines"))
    made = lines.select(*keep, F.array_join("_lines", "\n").alias("_text"), marked(F.col("_lines")).alias("_marks")).mapInArrow(run, schema)
    name = source_name(made)
    return made.withColumn("section_id", F.format_string("%s:section:%04d", name.cast("string"), F.col("section_no"))).withColumn("body", T.strip(F.col("rows")))
