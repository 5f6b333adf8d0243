"""The corpus pipeline: each stage calls one operator, is written as Parquet, and is read again as the next one's documents.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a DataFrame.  All but the last keep the columns of
documents.  ``ORACLE_SQL`` is None: SQL expresses neither the language model nor the tokenizer; tests hold every stage
against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.llm import bpe, chosen_path, decontaminate, language_id, pii
from docmill.llm.common import forget, table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a determined language go, and those whose shortest code under any learned language is longer than they are;
    a document without a language label gets the predicted one."""
    model = language_id.train(docs.where(~language_id.held_out()))
    kept = language_id.keep(docs, model, "_lang")
    return kept.withColumn("lang", F.coalesce("lang", F.nullif("_lang", F.lit(language_id.UNDETERMINED)))).select(*docs.columns)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of exact and near copies stays, that with the least doc_id."""
    return chosen_path.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), each_text=True)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the new text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the text's token ids, and the digest of what they decode to."""
    ids = bpe.encode_column(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return ids.select("doc_id", "lang", "source", F.size("token_ids").cast("bigint").alias("n_tokens"), "token_ids", "decoded_sha256")


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", join_near_copies),
    ("decontamination", remove_benchmark),
    ("pii", redact_personal_data),
    ("byte_bpe", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if k:
            forget(before)  # the next stage's rows hold all that is needed of it
    return STAGES[-1][1](spark, docs, sf_dir)
