"""The thin ``opN_<name>`` queries over the driver tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docmill.llm import fill_middle, spelling
from docmill.llm.common import table


def op1_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docmill.llm.language_id import held_out, identify, train

    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs.where(~held_out())))


def op2_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docmill.llm.pii import detect

    return detect(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docmill.llm.bpe import encode_decode

    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docmill.llm.chosen_path import join

    return join(table(spark, sf_dir, "documents"))


def op5_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docmill.llm.toxicity import predict, train

    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs, table(spark, sf_dir, "labels")))


def op6_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docmill.llm.secrets import scan

    return scan(table(spark, sf_dir, "documents"))


def op7_media_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docmill.llm.media import round_trip

    return round_trip(table(spark, sf_dir, "documents"))


def op8_bitpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docmill.llm.bitpack import token_files

    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docmill.llm.ngram_lm import model_scores

    return model_scores(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docmill.llm.decontaminate import hits

    return hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), each_text=True)


def op11_html_lstm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docmill.llm.html_extract import extract, train

    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docmill.llm.fill_middle import digests

    return digests(table(spark, sf_dir, "documents"))


def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from docmill.llm.spelling import group

    return group(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ppm_language, op2_pii_weak_supervision, op3_byte_bpe, op4_chosen_path, op5_toxicity_ordinal, op6_secret_novelty, op7_media_chunks, op8_bitpack, op9_elias_fano_lm,
        op10_decontaminate, op11_html_lstm, op12_fill_middle, op13_spelling_groups,
    )
}
ORACLE_SQL: dict[str, str] = {"op12_fill_middle": fill_middle.SQL, "op13_spelling_groups": spelling.SQL}
