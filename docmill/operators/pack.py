"""Size-bounded pieces: greedy packing over lengths, and the overlapping window splitter.

Both are Arrow-batched: a greedy fold that remembers its groups has no built-in of linear time.  Only what is too long goes to Python; all else
is sent as null and stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from docmill.functions.arrays import slices

#: Where a window may end, best first: after a paragraph break, a line break, a sentence, a space.
BREAKS = ("\n\n", "\n", ". ", " ")


def window_bounds(text: str, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """(begin, end) of windows of at most ``size`` code points: a window ends after the last break, of the best kind that has one, that begins
    beyond the overlap; the next window begins ``overlap`` before that end."""
    begin = 0
    while begin + size < len(text):
        found = ((text.rfind(kind, begin + overlap, begin + size), len(kind)) for kind in BREAKS)
        end = next((at + width for at, width in found if at >= 0), begin + size)
        yield begin, end
        begin = max(begin + 1, end - overlap)
    yield begin, len(text)


def windows(text: str, size: int, overlap: int) -> list[str]:
    """Windows of a long text, stripped, empty ones dropped; a short text is returned as it is."""
    if len(text) <= size:
        return [text]
    return [p for p in (text[a:b].strip() for a, b in window_bounds(text, size, overlap)) if p]


def greedy(units: list[tuple[int, int, int]], base: int, gap: int, cap: int, alone: bool = False) -> list[tuple[int, int]]:
    """(first unit, units) of each group of (length, lead, trail) units.

    A group's length is ``base``, its units' and ``gap`` between them, less the first unit's ``lead`` and the last's ``trail``.  A unit
    that would take a group over ``cap`` starts the next.  With ``alone``, a unit that reaches the cap by itself closes its group."""
    groups: list[tuple[int, int]] = []
    total, closed = 0, True
    for i, (n, _, trail) in enumerate(units):
        first, count = groups[-1] if groups else (0, 0)
        if closed or base + total + gap + n - units[first][1] - trail > cap:
            groups.append((i, 1))
            total, closed = n, alone and base + n >= cap
        else:
            groups[-1] = (first, count + 1)
            total += gap + n
    return groups


def row_pieces(rows: list[str], size: int) -> list[str]:
    """A table's rows in groups that repeat its two header lines; rows never split; a table without rows stays."""
    header, body = "\n".join(rows[:2]), rows[2:]
    return ["\n".join([header, *body[i : i + n]]) for i, n in greedy([(len(r), 0, 0) for r in body], len(header) + 1, 1, size)]


def item_pieces(rows: list[str], items: list[int], size: int) -> list[str]:
    """A list's items in groups; an item never splits."""
    starts = [i for i, item in enumerate(items) if i == 0 or item != items[i - 1]]
    texts = ["\n".join(rows[a:z]) for a, z in zip(starts, [*starts[1:], len(rows)])]
    units = [(len(t), len(t) - len(t.lstrip()), len(t) - len(t.rstrip())) for t in texts]
    return ["\n".join(texts[i : i + n]).strip() for i, n in greedy(units, 0, 1, size)]


def block_pieces(kind: str, text: str, rows: Sequence[str], items: Sequence[int], size: int, overlap: int) -> list[str]:
    """Pieces of a block that is too long: groups of rows, groups of items, or windows."""
    if kind == "table":
        return row_pieces(list(rows), size) if len(rows) > 2 else [text]
    return item_pieces(list(rows), list(items), size) if kind == "list" else windows(text, size, overlap)


@F.pandas_udf(ArrayType(StringType()))
def window_split(text: pd.Series, size: pd.Series, overlap: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else windows(t, s, o) for t, s, o in zip(text, size, overlap)], dtype=object)


@F.pandas_udf(ArrayType(StringType()))
def long_block(kind: pd.Series, text: pd.Series, lines: pd.Series, items: pd.Series, size: pd.Series, overlap: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else block_pieces(k, t, rows, own, s, o) for k, t, rows, own, s, o in zip(kind, text, lines, items, size, overlap)], dtype=object)


@F.pandas_udf(ArrayType(StructType([StructField("at", IntegerType()), StructField("n", IntegerType())])))
def groups_of(lengths: pd.Series, base: pd.Series, size: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else [{"at": i, "n": n} for i, n in greedy([(int(u), 0, 0) for u in x], b, 2, s, True)] for x, b, s in zip(lengths, base, size)], dtype=object)


groups_of = groups_of.asNondeterministic()  # so that it isn't moved into the lambdas that use it


def windowed(text: Column, size: Column, overlap: Column) -> Column:
    """array<string>: a text within ``size`` as it is, else its windows."""
    long = F.length(text) > size
    return F.coalesce(window_split(F.when(long, text), size, overlap), F.array(text))


def split_block(kind: Column, text: Column, lines: Column, size: int, overlap: int) -> Column:
    """array<string>: a block within ``size`` as it is; else rows, items or windows.  ``lines`` is array<struct<line, item>>."""
    long = F.length(text) > size
    rows = F.when(long & (kind != "paragraph"), lines)
    pieces = long_block(kind, F.when(long, text), F.transform(rows, lambda x: x["line"]), F.transform(rows, lambda x: x["item"]), F.lit(size), F.lit(overlap))
    return F.coalesce(pieces, F.array(text))


def pack(rows: DataFrame, pieces: str, heading_raw: Column, size: int) -> DataFrame:
    """Adds ``groups``: groups of the column array<struct<text, ...>> for passages of about ``size`` with the heading counted; a lone
    piece is a group."""
    base = F.coalesce(F.length(heading_raw) + 2, F.lit(0))
    lengths = F.when(F.size(pieces) > 1, F.transform(pieces, lambda p: F.length(p["text"])))
    bounded = rows.withColumn("_bounds", groups_of(lengths, base, F.lit(size)))
    return bounded.withColumn("groups", F.coalesce(slices(F.col(pieces), F.col("_bounds")), F.array(pieces))).drop("_bounds")
