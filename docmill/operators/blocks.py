"""Blocks of a section: runs of table lines, lists with their continuations, paragraphs."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from docmill.functions import text as T

#: Classes of lines as they go to the fold.
CLASSES = ("blank", "table", "list", "paragraph")
#: Blocks, or code points of them, that leave a fold at once.
BATCH, BATCH_CHARS = 512, 1 << 20
_FOLDED = "block int, block_type string, text string, page_start int, page_end int, lines array<struct<line:string,item:int>>"
_LINES = pa.list_(pa.struct([("line", pa.string()), ("item", pa.int32())]))


def classes(rows: Column) -> Column:
    """array<int>: the class of each line, as its place in ``CLASSES``."""
    return F.transform(F.split(rows, "\n", -1), lambda line: F.array_position(F.array(*[F.lit(c) for c in CLASSES]), T.line_class(line)).cast("int") - 1)


def runs(of: Iterable[int]) -> list[tuple[str, list[int], list[int]]]:
    """(type, numbers of its lines, item of each) of runs of table lines, lists with their continuations, and paragraphs."""
    out: list[tuple[str, list[int], list[int]]] = []
    mode = None
    for at, k in enumerate(of):
        kind = CLASSES[k]
        now = None if kind == "blank" else "list" if kind == "paragraph" and mode == "list" else kind
        if now and now != mode:
            out.append((now, [], []))
        mode = now
        if now:
            _, held, items = out[-1]
            items.append((items[-1] if items else 0) + (kind == "list"))
            held.append(at)
    return out


def pages_of(turns: list[dict], n: int) -> list[int]:
    """The page of each of a body's ``n`` lines."""
    out: list[int] = []
    for t, after in zip(turns, [*turns[1:], {"at": n}]):
        out += [t["page"]] * (after["at"] - t["at"])
    return out


def folded(sections: DataFrame) -> DataFrame:
    """(source, section_no, block, block_type, text, page_start, page_end, lines) of ``sections.folded`` rows; ``lines`` is array<struct<line, item>>.

    Blocks are dense from 1 within a section; each section is read where it lies, and nothing is shuffled or sorted."""
    own = StructType.fromDDL(_FOLDED)
    schema = StructType([sections.schema[c] for c in ("source", "section_no")] + [StructField(f.name, f.dataType) for f in own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32(), _LINES]
        for b in batches:
            held, of, chars = [], [], 0

            def out() -> pa.RecordBatch:
                place = pa.array(of, pa.int64())
                made = [pa.array(list(column), kind) for column, kind in zip(zip(*held), kinds)]
                return pa.RecordBatch.from_arrays([b.column(i).take(place) for i in range(2)] + made, schema.names)

            for row in range(b.num_rows):
                rows, of_lines, turns = (b.column(i)[row].as_py() for i in (2, 3, 4))
                lines = rows.split("\n")
                pages = pages_of(turns, len(lines))
                for n, (kind, at, items) in enumerate(runs(of_lines), 1):
                    text = "\n".join(lines[i] for i in at).strip()
                    held.append((n, kind, text, pages[at[0]], pages[at[-1]], [{"line": lines[i], "item": item} for i, item in zip(at, items)]))
                    of.append(row)
                    chars += len(text)
                    if len(held) == BATCH or chars > BATCH_CHARS:
                        yield out()
                        held, of, chars = [], [], 0
            if held:
                yield out()

    return sections.select("source", "section_no", "rows", classes(F.col("rows")).alias("_classes"), "turns").mapInArrow(run, schema)
