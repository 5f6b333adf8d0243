import re

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from test_bpe import PATTERN, RANKS
from test_chosen_path import brute
from test_decontaminate import brute as contained
from test_pii import BASE, valid

import corpus_pipeline as C
from docmill.llm.bpe import Engine

SF = "/root/testdata/sf0.001"


def redacted(text):
    spans = sorted((m.start(), i, m.end(), k) for i, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, text) if valid(k, m.group()))
    out, at = "", 0
    for a, _, b, k in spans:
        if a >= at:
            out, at = out + text[at:a] + f"[{k.upper()}]", b
        else:
            at = max(at, b)
    return out + text[at:]


def test_every_stage_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    names = [name for name, _ in C.STAGES]
    assert names == ["language_id", "ngram_jaccard_join", "decontamination", "pii", "byte_bpe"]
    stage = dict(C.STAGES)

    first = stage["language_id"](spark, docs, SF)
    assert first.columns == docs.columns
    kept = {r.doc_id: r for r in first.collect()}
    assert set(kept) == {d for d, r in rows.items() if any(c.isalpha() for c in r.text or "")}
    assert all(kept[d] == rows[d] for d in kept)

    second = stage["ngram_jaccard_join"](spark, first, SF)
    assert second.columns == docs.columns
    best = {c for c, _ in brute([(d, r.text) for d, r in kept.items()]).values()}
    assert {r.doc_id for r in second.collect()} == best

    third = stage["decontamination"](spark, second, SF)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {h[0] for h in contained([(d, rows[d].text) for d in best], items)}
    assert bad and {r.doc_id for r in third.collect()} == best - bad

    fourth = stage["pii"](spark, third, SF)
    assert fourth.columns == docs.columns
    texts = {r.doc_id: r.text for r in fourth.collect()}
    assert texts == {d: redacted(rows[d].text) for d in best - bad}
    assert any("[EMAIL]" in t for t in texts.values())

    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=Engine.get(RANKS, public_tokenizers.PATTERN).rank, special_tokens={})
    want = {d: library.encode_ordinary(t) for d, t in texts.items()}
    assert {r.doc_id: r.token_ids for r in stage["byte_bpe"](spark, fourth, SF).collect()} == want
    assert {r.doc_id: r.token_ids for r in C.run(spark, SF).collect()} == want


def test_edges(spark, tmp_path):
    rows = [(1, None, "en", "s"), (2, "", None, "s"), (None, "some words without an id", None, None), (4, "words here, mail a@b.co now", None, "s"), (4, "words here, mail a@b.co now", None, "s"), (5, "漢字", "zh", "s")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    folder = tmp_path / "sf"
    for table, name in ((docs, "documents"), (spark.createDataFrame([(1, "")], "item_id bigint, text string"), "benchmark")):
        table.write.parquet(str(folder / f"{name}.parquet"))
    got = {r.doc_id: r for r in C.run(spark, str(folder)).collect()}
    assert set(got) == {None, 4, 5} and got[4].lang is None  # the one label is held out: nothing is learnt
    empty = tmp_path / "empty"
    docs.limit(0).write.parquet(str(empty / "documents.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(empty / "benchmark.parquet"))
    assert C.run(spark, str(empty)).count() == 0


def test_language_stage_rejects_by_the_model(spark, tmp_path):
    rows = [(i, f"plain words of a learned language come and go, number {i} of many", "en", "s", 1) for i in range(100)] + [(200, "русский текст из многих слов " * 5, "en", "s", 1), (202, "123 456", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    unseen = docs.withColumn("lang", F.when(F.col("doc_id") < 100, F.col("lang")))  # a learned script's text stays, whatever its label
    assert {r.doc_id for r in C.identify_language(spark, unseen, str(tmp_path)).collect()} == set(range(100))
