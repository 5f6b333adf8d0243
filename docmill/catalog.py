"""Named queries over the driver tables and the DuckDB SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.functions import text as T
from docmill.operators import blocks as B
from docmill.operators import ann, bundle, chunks, filters, lines, ordinals, pack, sections, vectors
from docmill.plans import oracles
from docmill.plans.markdown import decorated, from_html
from docmill.sources import readers, webpages

QUERIES: dict = {}
FLAGSHIP = "q_chunks_full"


def query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "documents").select(F.col("doc_id").alias("source"), "text")


def _md(spark: SparkSession, d: str) -> DataFrame:
    """Markdown of the documents, which are dealt out before it is made: a file of one row group would be one task."""
    return decorated(_table(spark, d, "documents").select("doc_id", "text").repartition("doc_id"))


def _md_lines(spark: SparkSession, d: str) -> DataFrame:
    return lines.numbered(_md(spark, d).select("source", T.strip_spans(F.col("text")).alias("text")))


def _paged(spark: SparkSession, d: str) -> DataFrame:
    return lines.paged(_md_lines(spark, d))


def _sections(spark: SparkSession, d: str) -> DataFrame:
    return sections.folded(_md(spark, d))


@query
def q_lines(spark, d):
    return lines.numbered(_docs(spark, d))


@query
def q_page_fill(spark, d):
    return _paged(spark, d)


@query
def q_heading_detect(spark, d):
    return lines.with_headings(_md_lines(spark, d)).where("heading IS NOT NULL").select("source", "line_no", "heading.level", "heading.raw", F.col("heading.text").alias("heading_text"))


@query
def q_heading_path(spark, d):
    return _sections(spark, d).select("source", "section_no", F.array_join("path", " / ").alias("path"), T.breadcrumb(F.col("path")).alias("breadcrumb"))


@query
def q_sections(spark, d):
    return _sections(spark, d).select("source", "section_no", "section_id", "level", "heading_raw", "heading_text", "page_start", "page_end", "body")


@query
def q_classify_lines(spark, d):
    return _md_lines(spark, d).select("source", "line_no", T.line_class(F.col("line")).alias("class"))


@query
def q_html_lines(spark, d):
    rows = lines.with_headings(lines.numbered(from_html(_table(spark, d, "pages")))).where(T.strip(F.col("line")) != "")
    return rows.groupBy("source").agg(
        F.count("*").alias("n_lines"), F.count("heading").alias("n_headings"), F.count_if(T.line_class(F.col("line")) == "list").alias("n_list"), F.sum(F.length(T.inline(F.col("line")))).alias("n_chars")
    )


@query
def q_html_markdown(spark, d):
    """Markdown of every page, or its error."""
    made = webpages.extract(_table(spark, d, "pages"), "page_id", base="url")
    return made.select(F.col("source").cast("bigint").alias("page_id"), "markdown", "error")


@query
def q_blocks(spark, d):
    return B.folded(_sections(spark, d)).drop("lines")


@query
def q_skip_reasons(spark, d):
    return filters.explained(chunks.sections(_md(spark, d))).select("source", "section_no", F.coalesce("reason", F.lit("kept")).alias("reason"))


@query
def q_strip_spans(spark, d):
    return _md(spark, d).select("source", T.strip_spans(F.col("text")).alias("stripped"), T.span_count(F.col("text")).alias("n_spans"))


@query
def q_span_totals(spark, d):
    n = T.span_count(F.col("text"))
    return _md(spark, d).agg(F.count("*").alias("files"), F.count_if(n == 0).alias("unchanged"), F.sum(n).cast("bigint").alias("removed"))


@query
def q_page_markers(spark, d):
    """Every line of the texts, and after each a page marker and what misses one by a dash."""
    n = F.col("line_no")
    marker, not_quite = F.concat(F.lit("{"), n, F.lit("}"), F.repeat(F.lit("-"), F.lit(48))), F.concat(F.lit("{7}"), F.repeat(F.lit("-"), F.lit(47)))
    every = lines.numbered(_docs(spark, d)).select("source", "line_no", F.posexplode(F.array("line", marker, not_quite)).alias("part", "line"))
    return every.select("source", "line_no", "part", T.page_marker_line(F.col("line")).alias("line"))


@query
def q_inline_strip(spark, d):
    return _md_lines(spark, d).select("source", "line_no", T.inline(F.col("line")).alias("plain"), T.heading_key(F.col("line")).alias("key"))


@query
def q_footer_strip(spark, d):
    return _md_lines(spark, d).select("source", "line_no", T.footer(F.col("line")).alias("footer"), T.table_artifact(F.col("line")).alias("artifact"))


@query
def q_clean_text(spark, d):
    return _md(spark, d).select("source", T.clean(F.col("text")).alias("cleaned"))


@query
def q_window_split(spark, d):
    pieces = F.posexplode(pack.windowed(F.col("text"), F.lit(800), F.lit(100)))
    return _docs(spark, d).select("source", pieces.alias("piece_no", "piece"))


@query
def q_pack_blocks(spark, d):
    rows = lines.numbered(_docs(spark, d)).where(T.strip(F.col("line")) != "").withColumn("text", T.strip(F.col("line")))
    cells = rows.groupBy("source").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "text"))), lambda x: F.struct(x["text"].alias("text"))).alias("pieces"))
    groups = pack.pack(cells, "pieces", F.lit("# Heading"), 800).select("source", F.posexplode("groups").alias("group_no", "cells"))
    return groups.select("source", "group_no", F.size("cells").alias("n_blocks"), F.array_join("cells.text", "\n\n").alias("body"))


def _long_blocks(spark, d, kind):
    return B.folded(_sections(spark, d)).where((F.col("block_type") == kind) & (F.length("text") > 800))


def _pieces(rows):
    made = F.posexplode(pack.split_block(F.col("block_type"), F.col("text"), F.col("lines"), 800, 100))
    return rows.select("source", "section_no", "block", made.alias("piece_no", "piece"))


@query
def q_table_split(spark, d):
    return _pieces(_long_blocks(spark, d, "table"))


@query
def q_list_split(spark, d):
    return _pieces(_long_blocks(spark, d, "list"))


def _written_chunks(spark, d):
    return chunks.chunks(_md(spark, d))


@query
def q_chunks_full(spark, d):
    return _written_chunks(spark, d).withColumn("section_path", F.array_join("section_path", " / "))


@query
def q_chunks_dedup(spark, d):
    return chunks.prefixed(chunks.dedup(_written_chunks(spark, d))).select("index", "chunk_id", "source", "entry", T.label(F.col("entry")).alias("label"))


@query
def q_chunks_total(spark, d):
    return chunks.summary(_written_chunks(spark, d))


@query
def q_header_cap(spark, d):
    head = chunks.header(F.array(F.lit("Part"), F.col("text"), F.col("text")), F.concat(F.lit("# "), F.col("text")), chunks.ChunkConfig())
    return _docs(spark, d).select("source", head.alias("header"))


@query
def q_dedup_first(spark, d):
    return chunks.first_of_each(_table(spark, d, "documents").select("doc_id", "text"), "text", "doc_id").select("doc_id", F.length("text").alias("n_chars"))


@query
def q_dup_count(spark, d):
    groups = _table(spark, d, "documents").groupBy(F.sha2("text", 256).alias("digest")).agg(F.count("*").alias("n"))
    return groups.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_texts"), F.sum(F.col("n") - 1).alias("n_removed"))


@query
def q_chunk_summary(spark, d):
    return chunks.summary(q_window_split(spark, d).withColumnRenamed("piece", "text"))


@query
def q_chunks_per_source(spark, d):
    pieces = q_window_split(spark, d).groupBy("source").agg(F.count("*").alias("n"))
    return _docs(spark, d).select("source").join(pieces, "source", "left").select("source", F.coalesce("n", F.lit(0)).alias("n_chunks"))


@query
def q_global_index(spark, d):
    return ordinals.dense(lines.numbered(ordinals.in_order(_docs(spark, d), "source")).select("source", "line_no"), "row_id")


@query
def q_slice(spark, d):
    return ordinals.dense(lines.numbered(ordinals.in_order(_docs(spark, d), "source")).select("line"), "row_id").where(F.col("row_id").between(101, 300)).select("row_id", "line")


@query
def q_normalize_ids(spark, d):
    return _table(spark, d, "pages").select("page_id", T.normalized_id(F.col("url")).alias("normalized_id"))


@query
def q_norm_collisions(spark, d):
    urls = _table(spark, d, "pages").select(F.col("url").alias("source"))
    return bundle.collisions(urls.union(urls.select(F.replace("source", F.lit("/"), F.lit("_")))))


@query
def q_exclude_anti(spark, d):
    bad = _table(spark, d, "labels").where("toxic = 1").select("doc_id")
    return readers.without(_table(spark, d, "documents").select("doc_id", "source"), bad, "doc_id")


@query
def q_unresolved_sources(spark, d):
    """Documents without a label."""
    source = F.col("doc_id").alias("source")
    return bundle.unresolved(_table(spark, d, "documents").select(source), _table(spark, d, "labels").select(source))


@query
def q_resolve_first(spark, d):
    """The first label, as a path, of every document."""
    path = F.format_string("%s/%s", F.col("quality").cast("string"), F.col("toxic").cast("string")).alias("rel_path")
    return bundle.resolve(_table(spark, d, "documents").select(F.col("doc_id").alias("source")), _table(spark, d, "labels").select(F.col("doc_id").alias("source"), path))


@query
def q_sha256(spark, d):
    return _table(spark, d, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), F.octet_length("text").cast("bigint").alias("file_size"))


@query
def q_manifest(spark, d):
    pages = _table(spark, d, "pages").select(F.col("url").alias("source"), F.col("url").alias("rel_path"), F.octet_length("html").cast("bigint").alias("length"), F.col("html").cast("binary").alias("content"))
    return bundle.document_entries(bundle.resolve(pages.select("source").distinct(), pages), pages)


@query
def q_manifest_json(spark, d):
    """A bundle of one file for each document, with the nations as artefacts."""
    name = F.lpad(F.col("doc_id").cast("string"), 12, "0")
    files = _table(spark, d, "documents").select(name.alias("source"), name.alias("rel_path"), F.octet_length("text").cast("bigint").alias("length"), F.col("text").cast("binary").alias("content"))
    nations = _table(spark, d, "nation").select(F.col("n_nationkey").alias("position"), F.col("n_name").alias("rel_path"), F.octet_length("n_name").cast("bigint").alias("length"), F.col("n_name").cast("binary").alias("content"))
    return bundle.manifest(bundle.document_entries(bundle.resolve(files.select("source"), files), files), bundle.artifact_entries(nations), "v1")


@query
def q_checksums(spark, d):
    return bundle.checksums(q_manifest(spark, d), "bundle_path")


@query
def q_bad_entries(spark, d):
    """Every address, as it is or hidden in a way that a bundle must not hold."""
    url = F.col("url")
    hidden = F.element_at(F.array(F.concat(F.lit("x/._"), url), F.concat(F.lit("__MACOSX/"), url), F.concat(url, F.lit("/.DS_Store")), url), (F.col("page_id") % 4 + 1).cast("int"))
    return bundle.bad_entries(_table(spark, d, "pages").select("page_id", hidden.alias("path")))


@query
def q_bundle_totals(spark, d):
    return bundle.totals(_table(spark, d, "pages").select(F.octet_length("html").alias("length")))


def _entries(spark, d):
    return _docs(spark, d).select("source", F.concat(F.lit("<sep>[SOURCE:src"), F.col("source") % 20, F.lit("|PAGE:1]\n"), F.replace("text", F.lit("\n"), F.when(F.col("source") % 5 == 0, F.lit("\n<sep>")).otherwise(F.lit("\n")))).alias("file"))


@query
def q_chunkfile_roundtrip(spark, d):
    return _entries(spark, d).select("source", F.posexplode(readers.records(F.col("file"))).alias("record_no", "entry"))


@query
def q_count_separators(spark, d):
    return lines.numbered(_entries(spark, d).select("source", F.col("file").alias("text"))).groupBy("source").agg(F.count_if(F.col("line").startswith("<sep>")).alias("n"))


@query
def q_source_ids(spark, d):
    return readers.source_ids(q_chunkfile_roundtrip(spark, d))


@query
def q_labels(spark, d):
    return q_chunkfile_roundtrip(spark, d).groupBy(T.label(F.col("entry")).alias("label")).agg(F.count("*").alias("n"))


@query
def q_union_corpora(spark, d):
    a = _docs(spark, d).select(F.lit(0).alias("corpus_rank"), F.col("source").cast("string").alias("source"), "text")
    b = _table(spark, d, "pages").select(F.lit(1).alias("corpus_rank"), F.col("page_id").cast("string").alias("source"), F.col("html").alias("text"))
    kept, skipped = readers.corpora(a, b, skip=("3", "5"))
    return kept.groupBy("corpus_rank").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.lit("kept").alias("state")).unionByName(skipped.groupBy(F.lit(-1).alias("corpus_rank")).agg(F.count("*").alias("n"), F.lit(0).cast("bigint").alias("chars"), F.max("reason").alias("state")))


@query
def q_progress(spark, d):
    rows = _table(spark, d, "conversations").select(F.col("conv_id").alias("worker"), F.col("turn").alias("seq"), F.concat(F.lit("[##--] "), F.col("turn"), F.lit("/ "), F.length("text"), F.lit("  eta 00:"), F.lpad(F.col("turn").cast("string"), 2, "0"), F.lit("  part "), F.col("role")).alias("line"))
    return readers.progress(rows)


@query
def q_vf32_roundtrip(spark, d):
    blob = _table(spark, d, "embeddings").select("vec_id", "embedding", vectors.vf32_encode(F.col("embedding")).alias("blob"))
    back = blob.select("vec_id", "blob", vectors.vf32_decode(F.col("blob")).alias("v"))
    return back.select("vec_id", F.octet_length("blob").cast("bigint").alias("n_bytes"), F.hex(F.substring("blob", 1, 4)).alias("prefix"), F.size("v").cast("bigint").alias("dim"), F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double")), 4).alias("total"))


@query
def q_token_pad(spark, d):
    ids = F.transform(F.split("text", " "), lambda w: F.length(w))
    return _docs(spark, d).select("source", F.array_join(vectors.pad(ids, 1024), " ").alias("ids"))


@query
def q_embed_stub(spark, d):
    rows = vectors.embed(_docs(spark, d))
    blob, v = vectors.vf32_encode(F.col("vector")), F.col("vector")

    def size(x):
        """-1 without a vector; ``size`` alone is null there in ANSI mode."""
        return F.coalesce(F.size(x), F.lit(-1))

    filled = size(F.filter(v, lambda x: x != 0)).alias("n_filled")
    peak = F.array_position(v, F.array_max(v)).alias("peak")
    return rows.select("source", size(v).alias("dim"), F.octet_length(blob).cast("bigint").alias("n_bytes"), filled, peak, "error")


def _turns(spark, d):
    """Turns of conversations, and after every tenth one without words."""
    turns = _table(spark, d, "conversations").select("conv_id", "turn", "text")
    return turns.unionByName(turns.where("turn % 10 = 0").select("conv_id", (-F.col("turn") - 1).alias("turn"), F.lit(" ").alias("text")))


@query
def q_embed_counts(spark, d):
    return vectors.outcome(vectors.embed(_turns(spark, d)))


@query
def q_embed_errors(spark, d):
    return vectors.failed(vectors.embed(_turns(spark, d))).select("conv_id", "turn", "error")


@query
def q_cosine_topk(spark, d):
    rows = _table(spark, d, "embeddings")
    return vectors.top_k(rows.where("vec_id % 20 = 0"), rows, 5)


@query
def q_ivf_topk(spark, d):
    """Approximate search over every row of an inverted file; recall is tested against ``q_cosine_topk``."""
    rows = _table(spark, d, "embeddings")
    coder = ann.train(rows, 32, 16)
    return ann.search(rows.where("vec_id % 20 = 0"), ann.index(rows, coder), rows, coder, 5, probes=24, refine=128)


@query
def q_events_windows(spark, d):
    """The batch form of the streaming windowed count."""
    return _table(spark, d, "events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.unix_timestamp("w.start").alias("start"), "event_type", "n")


ORACLE_SQL: dict = {k: v for k, v in oracles.SQL.items() if k in QUERIES}
