"""Sinks: passage text files, JSON sidecars, vector tables, SQLite export."""

from __future__ import annotations

import os
import sqlite3
import uuid
from collections.abc import Iterable, Iterator
from contextlib import closing
from itertools import chain
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from docmill.operators.chunks import prefixed


def entry(c: Column) -> Column:
    return F.concat(F.lit("<sep>"), c)


def write_passages(chunks: DataFrame, path: str, one_file: bool = False) -> None:
    """Passage text in index order: range-partitioned files, or one file where the exact artefact is wanted."""
    rows = prefixed(chunks)
    rows = rows.coalesce(1).sortWithinPartitions("index") if one_file else rows.repartitionByRange("index").sortWithinPartitions("index")
    rows.select(entry(F.col("entry")).alias("value")).write.mode("overwrite").text(path)


def write_counted(chunks: DataFrame, path: str) -> Row:
    """Passages as Parquet, and their ``summary``, taken by the same scan as they are written."""
    seen = Observation("passages")
    n, total = F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))
    chunks.observe(seen, n.alias("n_chunks"), total.cast("bigint").alias("total_chars")).write.mode("overwrite").parquet(path)
    found = seen.get
    return Row(n_chunks=found["n_chunks"], total_chars=found["total_chars"], avg_chars=found["total_chars"] // max(found["n_chunks"], 1))


SIDECAR = ("chunk_id", "source", "page_start", "page_end", "section_id", "section_path", "chunk_type", "text")


def write_sidecar(chunks: DataFrame, path: str) -> None:
    """JSON lines of eight fields; nulls are kept and other scripts aren't escaped."""
    chunks.repartitionByRange("index").sortWithinPartitions("index").select(*SIDECAR).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_markdown(docs: DataFrame, path: str) -> None:
    docs.write.mode("overwrite").partitionBy("corpus_rank").parquet(path)


def export_markdown(docs: DataFrame, folder: str, skip_existing: bool = False) -> None:
    """One ``<source>.md`` a document of (source, text), written by tasks into a folder that they share; a file appears whole or not at all."""
    Path(folder).mkdir(parents=True, exist_ok=True)

    def store(rows: Iterator[Row]) -> None:
        for row in rows:
            target = Path(folder) / f"{row.source}.md"
            if skip_existing and target.exists():
                continue
            part = target.with_name(f".{uuid.uuid4().hex}.part")
            part.write_text(row.text or "", encoding="utf-8", newline="")
            os.replace(part, target)

    docs.select("source", "text").foreachPartition(store)


def _vector_table(path: str, rows: Iterable[Row], batch: int, first: int | None = None) -> int:
    """Write (text, embeddings) rows to a new SQLite file, committed every ``batch`` rows; returns their number.  With ``first``, ids are those of the rows."""
    n = 0
    with closing(sqlite3.connect(path)) as db:
        db.execute("PRAGMA journal_mode = MEMORY")
        db.execute("PRAGMA synchronous = OFF")
        db.execute("DROP TABLE IF EXISTS rag_vector_store")
        db.execute("CREATE TABLE rag_vector_store (ROWID INTEGER PRIMARY KEY AUTOINCREMENT, text TEXT NOT NULL, embeddings REAL NOT NULL)")
        for row in rows:
            number = None if first is None else row.row_id
            db.execute("INSERT INTO rag_vector_store (ROWID, text, embeddings) VALUES (?, ?, ?)", (number, row.text, bytes(row.embeddings)))
            n += 1
            if n % batch == 0:
                db.commit()
        db.commit()
    return n


def export_sqlite_parts(vectors: DataFrame, folder: str, parts: int | None = None, batch: int = 100) -> DataFrame:
    """(file, first, last, n): SQLite files of ranges of row_id, written by tasks into a folder that they share; rows keep their ids.

    A file appears whole, under a name of its range; a range that a task writes twice is the same file.  Files of an earlier export go first.
    ``readers.sqlite_rows`` reads them in tasks again."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    for old in Path(folder).glob("vectors-*.sqlite"):
        old.unlink()

    def store(rows: Iterator[Row]) -> Iterator[tuple]:
        held = next(rows, None)
        if held is None:
            return
        first, last = held.row_id, held.row_id

        def every() -> Iterator[Row]:
            nonlocal last
            for row in chain([held], rows):
                last = row.row_id
                yield row

        part = Path(folder) / f".{uuid.uuid4().hex}.part"
        n = _vector_table(str(part), every(), batch, first)
        target = Path(folder) / f"vectors-{first:012d}-{last:012d}.sqlite"
        os.replace(part, target)
        yield str(target), first, last, n

    ranged = vectors.select("row_id", "text", "embeddings")
    ranged = ranged.repartitionByRange(parts, "row_id") if parts else ranged.repartitionByRange("row_id")
    # Per-partition imperative work: a file has to be open while its rows go by.
    done = ranged.sortWithinPartitions("row_id").rdd.mapPartitions(store).collect()  # one row a file
    return vectors.sparkSession.createDataFrame(done, "file string, first bigint, last bigint, n bigint")


def export_sqlite(vectors: DataFrame, path: str, batch: int = 100) -> int:
    """Stream (row_id, text, embeddings) to one SQLite file on the driver, where that is the artefact wanted; returns the rows."""
    return _vector_table(path, vectors.orderBy("row_id").select("text", "embeddings").toLocalIterator(), batch)
