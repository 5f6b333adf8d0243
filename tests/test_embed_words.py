"""Texts without words, and what a word of the stand-in embedder is."""

import duckdb
import pytest
from pyspark.sql import types as T

from docmill import catalog

TEXTS = [
    None, "", " ", "\n\t\f\r ", "one", "One two  two\nthree", "a\x0bb", "\x0b", "a\x1cb c", "\x1f", "a\x85b", "\x85", "a\xa0b", "\xa0", "a b　c", " ", "a​b",
    "a\x00b", "İstanbul", "İ", "ΟΔΟΣ", "ΣΑΣ Σ", "ΑΣ.", "ẞ STRASSE", "Ǆ K Å", "x y x\ny",
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_embedded_texts_equal_sql(spark, tmp_path, ansi):
    spark.createDataFrame(list(enumerate(TEXTS)), T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])).write.parquet(f"{tmp_path}/documents.parquet")
    was = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = catalog.QUERIES["q_embed_stub"](spark, str(tmp_path))
        got = sorted(map(tuple, df.collect()))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", was)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = db.execute(f"SELECT {', '.join(df.columns)} FROM ({catalog.ORACLE_SQL['q_embed_stub']})").fetchall()
    assert got == sorted(want)
    assert [r[1:] for r in got[:4]] == [(-1, None, -1, None, "no words")] * 4


def test_counts_and_errors_of_turns_equal_sql(spark, tmp_path):
    texts = [t for t in TEXTS if t is not None]
    spark.createDataFrame([(i // 4, 9 + i % 4, t) for i, t in enumerate(texts)], "conv_id bigint, turn bigint, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    for name in ("q_embed_counts", "q_embed_errors"):
        df = catalog.QUERIES[name](spark, str(tmp_path))
        want = db.execute(f"SELECT {', '.join(df.columns)} FROM ({catalog.ORACLE_SQL[name]})").fetchall()
        assert sorted(map(tuple, df.collect())) == sorted(want), name
