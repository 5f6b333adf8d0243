"""The passage builder: sections to size-bounded, self-contained, numbered passages."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from docmill.config import ChunkConfig
from docmill.functions import text as T
from docmill.operators import blocks as B
from docmill.operators import filters, ordinals, pack
from docmill.operators import sections as S

def sections(docs: DataFrame) -> DataFrame:
    """Sections of (source, text) markdown, empty spans removed first.  With a ``corpus_rank``, ``source`` becomes the pair (corpus_rank, source)."""
    source = F.struct("corpus_rank", "source").alias("source") if "corpus_rank" in docs.columns else "source"
    return S.folded(docs.select(source, "text"))


def header(path: Column, heading_raw: Column, config: ChunkConfig) -> Column:
    """Breadcrumb and heading, capped so that ``size`` characters of body always fit."""
    whole = F.concat_ws("\n\n", T.breadcrumb(path), heading_raw)
    cap = config.max_chars - config.size - 2
    return F.when(F.length(whole) > cap, F.concat(F.substring(whole, 1, cap - 1), F.lit("…"))).otherwise(whole)


_PIECE = StructType([StructField(n, t) for n, t in (("part_no", IntegerType()), ("piece_no", IntegerType()), ("type", StringType()), ("page_start", IntegerType()), ("page_end", IntegerType()), ("text", StringType()))])
_PIECES = pa.list_(pa.struct([("part_no", pa.int32()), ("piece_no", pa.int32()), ("type", pa.string()), ("page_start", pa.int32()), ("page_end", pa.int32()), ("text", pa.string())]))


def packed(rows: str, classes: Iterable[int], turns: Iterable[dict], base: int, config: ChunkConfig) -> Iterator[tuple[str, int, int, str]]:
    """(type, first page, last page, text) of the parts of a long section, of about ``size`` with ``base`` counted."""
    lines = rows.split("\n")
    pages, units = B.pages_of(list(turns), len(lines)), []
    for kind, held, items in B.runs(classes):
        text = "\n".join(lines[i] for i in held).strip()
        pieces = [text] if len(text) <= config.size else pack.block_pieces(kind, text, [lines[i] for i in held], items, config.size, config.overlap)
        units += [(kind, pages[held[0]], pages[held[-1]], p.strip()) for p in pieces if p.strip()]
    for first, n in pack.greedy([(len(u[3]), 0, 0) for u in units], base, 2, config.size, True):
        own = units[first : first + n]
        kinds = {u[0] for u in own}
        yield kinds.pop() if len(kinds) == 1 else "mixed", own[0][1], own[-1][2], "\n\n".join(u[3] for u in own)


def pieces(kept: DataFrame, config: ChunkConfig) -> DataFrame:
    """Adds ``head`` and a row for each of a section's ``piece``s: struct<part_no, piece_no, type, page_start, page_end, text>.

    A short section is one piece; a long one is packed from its blocks; what is still over the hard bound with the header is cut
    into windows.  Only sections that need it go to Python."""

    def made(r, whole, c, t, heading, a, z, most):
        if whole is None:
            return None
        parts = [("section", a, z, whole)] if c is None else packed(r, c, t, heading, config)
        return [
            {"part_no": n, "piece_no": k, "type": kind, "page_start": p, "page_end": q, "text": piece.strip()}
            for n, (kind, p, q, text) in enumerate(parts) for k, piece in enumerate(pack.windows(text.strip(), most, config.overlap)) if piece.strip()
        ]

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            held, chars = [], 0
            for row in zip(*columns):
                held.append(made(*(x.as_py() for x in row)))
                chars += sum(len(x["text"]) for x in held[-1] or ())
                if len(held) == B.BATCH or chars > B.BATCH_CHARS:
                    yield pa.array(held, _PIECES)
                    held, chars = [], 0
            if held:
                yield pa.array(held, _PIECES)

    cut = F.arrow_udf(run, ArrayType(_PIECE))
    body = F.col("body")
    held = kept.withColumn("head", header(F.col("path"), F.col("heading_raw"), config)).withColumn("_long", F.length(T.rendered(F.col("heading_raw"), body)) > config.max_section)
    budget = F.lit(config.max_chars) - F.when(F.length("head") > 0, F.length("head") + 2).otherwise(0)
    base = F.coalesce(F.length("heading_raw") + 2, F.lit(0))

    long = F.col("_long")
    held = held.withColumn("_classes", F.when(long, B.classes(F.col("rows"))))
    made = cut(F.when(long, F.col("rows")), F.when(long | (F.length(body) > budget), body), F.col("_classes"), F.when(long, F.col("turns")), base, F.col("page_start"), F.col("page_end"), budget)
    whole = F.array(F.struct(F.lit(0).alias("part_no"), F.lit(0).alias("piece_no"), F.lit("section").alias("type"), "page_start", "page_end", body.alias("text")))
    return held.select("source", "section_no", "section_id", "path", "head", F.explode(F.coalesce(made, whole)).alias("piece"))


def emit(parts: DataFrame, config: ChunkConfig) -> DataFrame:
    """Put the header on every piece, clean, and drop short ones."""
    text = T.clean(F.concat_ws("\n\n", F.when(F.col("head") != "", F.col("head")), F.col("piece.text")))
    # A generator, so that the filter isn't pushed below the text and makes it a second time.
    made = parts.where(F.col("piece.text") != "").select("source", "section_no", "section_id", "path", "piece", F.explode(F.array(text)).alias("text"))
    return made.where(F.length("text") >= config.min_chars).select("source", "section_no", "section_id", "path", "piece.part_no", "piece.piece_no", "piece.type", "piece.page_start", "piece.page_end", "text")


def passages(docs: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """Passages of each document where it lies, in its order; nothing is shuffled."""
    return emit(pieces(filters.kept(sections(docs)), config), config)


def chunks(docs: DataFrame, config: ChunkConfig = ChunkConfig()) -> DataFrame:
    """All passages of (source, text) markdown with their global index, before duplicates go.  With a ``corpus_rank``, corpora come in its
    order, and it is the last column.

    Documents go in the order of corpus, name and text, null names first; those of one name in one corpus, or of none, keep all their passages.  This order is
    the one shuffle: passages are made in it and numbered as they come."""
    ranked = [c for c in ("corpus_rank",) if c in docs.columns]
    ordered = ordinals.in_order(docs.select(*ranked, "source", "text"), *ranked, "source", "text")
    numbered = ordinals.dense(passages(ordered, config), "index")
    name = S.source_name(numbered)
    return numbered.select(
        "index", F.format_string("%s:chunk:%05d", name.cast("string"), F.col("index")).alias("chunk_id"), name.alias("source"), "section_id", F.col("path").alias("section_path"),
        F.col("type").alias("chunk_type"), "page_start", "page_end", "text", *([F.col("source.corpus_rank").alias("corpus_rank")] if ranked else []),
    )


def first_of_each(rows: DataFrame, text: str, order: str) -> DataFrame:
    """The first row by ``order`` of every text: rows without an order come last, of rows that tie one stays, null texts are
    one text.  Keys are 32-byte digests, and each task keeps one row a key before the shuffle, so a text that a third of rows
    share gathers nowhere."""
    whole, rank = F.struct(*[F.col(f"`{c}`") for c in rows.columns]), F.struct(F.col(order).isNull(), F.col(order))
    return rows.groupBy(F.sha2(F.col(text).cast("binary"), 256).alias("_key")).agg(F.min_by(whole, rank).alias("_row")).select("_row.*")


def dedup(rows: DataFrame) -> DataFrame:
    return first_of_each(rows, "text", "index")


def prefixed(rows: DataFrame) -> DataFrame:
    """Adds ``entry``: the passage with its source line."""
    return rows.withColumn("entry", F.concat(F.format_string("[SOURCE:%s|PAGE:%d]\n", F.col("source").cast("string"), F.col("page_start")), "text"))


def summary(rows: DataFrame) -> DataFrame:
    n, total = F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))
    return rows.agg(n.alias("n_chunks"), total.cast("bigint").alias("total_chars"), F.when(n > 0, F.floor(total / n)).otherwise(0).cast("bigint").alias("avg_chars"))
