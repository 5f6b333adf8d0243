import random
import re

from model import SF, dropped, passages, plain, sections
from pyspark.sql import functions as F

from docmill.functions import text as T
from docmill.operators import chunks, filters
from docmill.operators import lines as L
from docmill.operators import sections as S
from docmill.plans.markdown import decorated


def test_full_builder_equals_sequential_rules(spark):
    docs = decorated(spark.read.parquet(f"{SF}/documents.parquet")).cache()
    rows = chunks.chunks(docs).orderBy("index").collect()
    texts = sorted((r.source, r.text) for r in docs.collect())
    want = [(s, n, k, a, z, t) for s, text in texts for n, k, a, z, t in passages(text)]
    got = [(r.source, int(r.section_id.rsplit(":", 1)[1]), r.chunk_type, r.page_start, r.page_end, r.text) for r in rows]
    assert got == want
    assert [r["index"] for r in rows] == list(range(1, len(rows) + 1))
    assert rows[4].chunk_id == f"{rows[4].source}:chunk:00005"
    assert all(80 <= len(r.text) <= 2500 for r in rows)
    first = {}
    for r in rows:
        first.setdefault(r.text, r["index"])
    assert sorted(r["index"] for r in chunks.dedup(spark.createDataFrame(rows)).collect()) == sorted(first.values())


def test_reasons_equal_sequential_rules(spark):
    docs = decorated(spark.read.parquet(f"{SF}/documents.parquet")).cache()
    got = {(r.source, r.section_no): r.why for r in filters.explained(chunks.sections(docs)).withColumnRenamed("reason", "why").collect()}
    want = {(r.source, n): dropped(s) for r in docs.collect() for n, s in enumerate(sections(r.text), 1)}
    assert got == want
    assert {"boilerplate", "subtree", "empty", "cross_reference", "blank_form", "sparse_template", "manual_index", "contents_list"} <= set(got.values())


def test_two_corpora_may_hold_one_name(spark):
    body = "Enough words to make a passage that is kept, as it is over eighty characters long in all. "
    rows = [(1, "a", f"# Two\nbeta {body}"), (0, "a", f"# One\nalpha {body}"), (0, "z", f"# Last\nshared {body}"), (1, "b", f"# Last\nshared {body}")]
    made = chunks.chunks(spark.createDataFrame(rows, "corpus_rank int, source string, text string")).cache()
    got = [(r["index"], r.corpus_rank, r.source, r.chunk_id, r.section_id, r.text[:6].strip()) for r in made.orderBy("index").collect()]
    assert got == [
        (1, 0, "a", "a:chunk:00001", "a:section:0001", "# One"), (2, 0, "z", "z:chunk:00002", "z:section:0001", "# Last"), (3, 1, "a", "a:chunk:00003", "a:section:0001", "# Two"),
        (4, 1, "b", "b:chunk:00004", "b:section:0001", "# Last"),
    ]
    assert sorted(r["index"] for r in chunks.dedup(made).collect()) == [1, 2, 3]  # the first corpus wins


def test_first_of_each_keeps_every_text_once(spark):
    rows = [("a", None, 1), ("b", 2, 2), ("b", 2, 3), ("b", None, 4), (None, 5, 5), (None, 4, 6), ("c", None, 7), ("c", None, 8)]
    got = chunks.first_of_each(spark.createDataFrame(rows, "text string, n int, i int"), "text", "n").collect()
    assert sorted((str(r.text), str(r.n)) for r in got) == [("None", "4"), ("a", "None"), ("b", "2"), ("c", "None")]


def test_cross_references_equal_the_plain_pattern(spark):
    rng = random.Random(4)
    parts = ["Recommendation", "recommendations", " ", "\n", "1", ".2", ",", "and", " to ", "–", "-", ".", "x", "AND", "**", "[1](u)", "٣"]
    texts = [("Recommendations " if k % 2 else "") + "".join(rng.choice(parts) for _ in range(rng.randrange(12))) for k in range(20_000)]
    pattern = re.compile(r"(?i)\s*Recommendations?\s+[\d.]+(?:\s*(?:,|and|to|–|-)\s*[\d.]+)*\.?\s*$")
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", filters.cross_reference(F.col("t")).alias("x")).collect()
    assert any(r.x for r in rows) and all(bool(r.x) == bool(pattern.match(plain(texts[r.i]))) for r in rows)


def test_no_list_of_numbers_overflows_a_stack(spark):
    n = 100_000
    texts = ["Recommendations 1" + ", 2" * n, "Recommendation 1" + " and 2.3" * n + ".", "Recommendations 1" + " - 2" * n + " x", "Fever, A-1" + "-2" * n, "| a " * n + "|", "a 1\n" * n, "**" + "a b. " * n + "**", "\n\n" * n, "- item\n" * n, "#" + " #" * n]
    docs = spark.createDataFrame([(str(k), f"# Head {k}\n{t}") for k, t in enumerate(texts)], "source string, text string").repartition(4)
    why = {r.source: r.why for r in filters.explained(chunks.sections(docs)).withColumnRenamed("reason", "why").collect()}
    assert why["0"] == why["1"] == "cross_reference" and why["2"] is None and why["5"] == "contents_list"
    assert chunks.chunks(docs).count() > 0


def test_documents_of_one_name_or_of_none_stay_apart(spark):
    body = "Enough words to make a passage that is kept, as it is over eighty characters long in all. "
    rows = [("c", None), ("a", f"# One\nalpha {body}"), (None, f"# N\nnu {body}"), ("a", f"# Two\nbeta {body}\n# Three\ngamma {body}"), (None, f"# M\nmu {body}"), ("b", ""), ("a", f"# One\nalpha {body}")]
    docs = spark.createDataFrame(rows, "source string, text string").repartition(3)
    got = [(r["index"], r.source, " ".join(r.text.split()[1:3])) for r in chunks.chunks(docs).orderBy("index").collect()]
    assert got == [(1, None, "M mu"), (2, None, "N nu"), (3, "a", "One alpha"), (4, "a", "One alpha"), (5, "a", "Two beta"), (6, "a", "Three gamma")]
    ranked = docs.withColumn("corpus_rank", F.when(F.col("text").contains("alpha"), 1))
    assert [r.corpus_rank for r in chunks.chunks(ranked).orderBy("index").collect()] == [None] * 4 + [1] * 2


def test_the_builder_shuffles_once_before_numbering(spark):
    docs = spark.createDataFrame([("a", "# x\ny")], "source string, text string")
    plan = chunks.passages(chunks.ordinals.in_order(docs, "source"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan


def test_folded_sections_equal_those_of_line_rows(spark):
    docs = decorated(spark.read.parquet(f"{SF}/documents.parquet"))
    columns = ["source", "section_no", "section_id", "level", "heading_raw", "heading_text", "path", "page_start", "page_end", "body"]
    by_lines = S.sections(L.with_headings(L.paged(L.numbered(docs.select("source", T.strip_spans(F.col("text")).alias("text"))))))
    assert sorted(map(tuple, by_lines.select(columns).collect())) == sorted(map(tuple, chunks.sections(docs).select(columns).collect()))
