"""Sources: markdown corpora, web pages, delimited passage files, binary documents."""

from __future__ import annotations

import re
import sqlite3
from collections.abc import Iterator
from contextlib import closing

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docmill.config import SKIP_SOURCES
from docmill.functions import text as T
from docmill.operators.ordinals import written

SEP = "<sep>"


def file_name(c: Column | None = None) -> Column:
    """The file's own name: Spark gives it percent-encoded."""
    c = F.col("_metadata.file_name") if c is None else c
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def stem(c: Column) -> Column:
    return F.regexp_replace(c, r"\.[^.]*$", "")


def markdown(spark: SparkSession, folder: str, corpus_rank: int = 0) -> DataFrame:
    """(corpus_rank, source, text) of a folder's ``*.md`` files, line breaks unified."""
    rows = spark.read.text(folder, wholetext=True, pathGlobFilter="*.md")
    text = F.regexp_replace(F.col("value"), "\r\n?", "\n")
    return rows.select(F.lit(corpus_rank).alias("corpus_rank"), stem(file_name()).alias("source"), text.alias("text"))


def corpora(*frames: DataFrame, skip: tuple[str, ...] = SKIP_SOURCES) -> tuple[DataFrame, DataFrame]:
    """(kept, skipped): the union of corpora, and the skipped sources with the reason ``duplicate``."""
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.unionByName(f)
    out = F.col("source").isin(*skip)
    return rows.where(~out), rows.where(out).select("source", F.lit("duplicate").alias("reason"))


def binary_documents(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """(rel_path, source, length, content); ``pattern`` is a glob on names, case-sensitive, for flat scans."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", pattern).load(folder)
    path = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
    root = folder.rstrip("/").split("://")[-1]
    rel = F.regexp_replace(path, r"^(?:[a-z]+:)?/*" + re.escape(root.lstrip("/")) + "/", "")
    name = F.element_at(F.split(rel, "/"), -1)
    return rows.select(rel.alias("rel_path"), stem(name).alias("source"), "length", "content")


def pdfs(documents: DataFrame) -> DataFrame:
    """Case-insensitive ``.pdf`` names."""
    return documents.where(F.lower("rel_path").endswith(".pdf"))


def without(rows: DataFrame, other: DataFrame, on: str) -> DataFrame:
    """Anti join: exclusions, copies with a canonical document, outputs that exist already."""
    return rows.join(other.select(on).distinct(), on, "left_anti")


def records(text: Column) -> Column:
    """array<string> of a delimited passage text: a record starts at a line that begins with ``<sep>``; text before the
    first is a record, too; stripped, empty ones dropped."""
    parts = F.split(text, rf"(?:^|\n){SEP}", -1)
    return F.filter(F.transform(parts, T.strip), lambda s: s != "")


def passages(spark: SparkSession, path: str) -> DataFrame:
    """(file, record_no, entry) of passage files, by the rules of ``records``; numbers are dense within a file.

    Files are read in splits: ``<sep>`` at the start of a line is the record separator of Spark's line reader, so a large file goes to many tasks
    and no record is larger than itself in memory.  Records are written with their place in their split, and numbered from the splits' counts,
    one row each."""
    rows = spark.read.option("lineSep", f"\n{SEP}").text(path).select("_metadata.file_path", "_metadata.file_block_start", F.col("_metadata.file_name").alias("_name"), "value")

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds whether a row is its split's first; a task reads split after split."""
        last = None
        for b in batches:
            own = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
            first = [k != before for k, before in zip(own, [last, *own])]
            last = own[-1] if own else last
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(first, pa.bool_())], [*b.schema.names, "_begins"])

    rows = rows.mapInArrow(begun, "file_path string, file_block_start bigint, _name string, value string, _begins boolean")
    # A file's first record still has the separator of its first line.
    opening = F.col("_begins") & (F.col("file_block_start") == 0) & F.col("value").startswith(SEP)
    entry = T.strip(F.when(opening, F.substring("value", len(SEP) + 1, 1 << 30)).otherwise(F.col("value")))
    found = rows.withColumn("entry", entry).where("entry <> ''").drop("value", "_begins").withColumn("_at", F.monotonically_increasing_id())
    found = written(found, "records")
    split = ("file_path", "file_block_start")
    counts = found.groupBy(*split).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("file_path").orderBy("file_block_start").rowsBetween(Window.unboundedPreceding, -1))
    placed = found.join(counts.withColumn("_before", F.coalesce(before, F.lit(0))), [*split])
    return placed.select(file_name(F.col("_name")).alias("file"), (F.col("_before") + F.col("_at") - F.col("_first")).alias("record_no"), "entry")


def count_separators(spark: SparkSession, path: str) -> DataFrame:
    """Lines that begin with ``<sep>``; may differ from the number of records."""
    return spark.read.text(path).where(F.col("value").startswith(SEP)).agg(F.count("*").alias("n"))


def source_ids(entries: DataFrame) -> DataFrame:
    """Distinct sources of passage entries."""
    found = F.regexp_extract("entry", r"^\[SOURCE:([^|]+)\|", 1)
    return entries.select(found.alias("source")).where("source <> ''").distinct()


def progress(log: DataFrame) -> DataFrame:
    """(worker, done, total, eta, label) of each worker's last record: its (worker, seq, line) log, whose lines may hold several, parted by
    carriage returns; blank ones don't count.  A record looks like ``[##--] 1234/ 2928  42.2%  elapsed 03:12  eta 04:22  label``; what
    it lacks is 0, ``--:--`` or empty, and a label has at most 40 characters."""
    records = F.filter(F.split("line", r"[\r\n]+", -1), lambda r: T.strip(r) != "")
    last = log.withColumn("_last", F.try_element_at(records, F.lit(-1))).groupBy("worker").agg(F.max_by("_last", F.when(F.col("_last").isNotNull(), F.col("seq"))).alias("r"))

    def part(pattern: str, group: int = 1) -> Column:
        return F.coalesce(F.regexp_extract("r", pattern, group), F.lit(""))

    def count(group: int) -> Column:
        return F.coalesce(part(r"\]\s*(\d+)\s*/\s*(\d+)", group).try_cast("int"), F.lit(0))

    eta, label = part(r"eta\s+(\S+)"), F.substring(T.strip(part(r"eta\s+\S+\s+(.*)")), 1, 40)
    return last.select("worker", count(1).alias("done"), count(2).alias("total"), F.when(eta != "", eta).otherwise("--:--").alias("eta"), label.alias("label"))


def sqlite_rows(spark: SparkSession, files: list[str], query: str = "SELECT seq, text, blob FROM part", schema: str = "seq bigint, text string, blob binary") -> DataFrame:
    """Rows of SQLite part files, with their ``file``; one task reads a file, a thousand rows at a time.  Tasks must see the files."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file in batch["file"]:
                with closing(sqlite3.connect(f"file:{file}?mode=ro", uri=True)) as db:
                    for rows in pd.read_sql_query(query, db, chunksize=1000):
                        yield rows.assign(file=file)

    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, len(files)), "file")
    return listed.mapInPandas(read, f"{schema}, file string")
