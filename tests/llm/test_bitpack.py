import zlib

import numpy as np
import public_tokenizers
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F
from test_bpe import fuzzed
from tokenizers import Tokenizer

from docmill.llm import bitpack as B
from docmill.llm.units import UnitIds

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("vocabulary", [2, 3, 257, 50_257, 65_536, 65_537, 200_000])
def test_pack_unpack(vocabulary):
    rng = np.random.default_rng(1)
    ids = rng.integers(0, vocabulary, 1003, dtype=np.uint32)
    bits = B.width(vocabulary)
    assert bits == max(1, (vocabulary - 1).bit_length())
    raw = B.pack(ids, bits)
    assert len(raw) == -(-1003 * bits // 8) and (B.unpack(raw, bits, 1003) == ids).all()


@pytest.mark.parametrize("bits", [16, 17])
def test_random_access(tmp_path, bits, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_IDS", 64)
    ids = np.random.default_rng(2).integers(0, 50_000, 5000, dtype=np.uint32)
    with open(tmp_path / "x", "wb") as f:
        w = B.Writer(f, bits)
        for part in np.split(ids, [1, 10, 700, 701, 4000]):
            w.add(part)
        w.close()
    r = B.Reader(pafs.LocalFileSystem().open_input_file(str(tmp_path / "x")))
    for a, b in ((0, 5000), (63, 65), (64, 128), (4999, 5000), (10, 10), (1234, 4321)):
        assert (r.read(a, b) == ids[a:b]).all()


def hashed(docs):
    return docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()


def check(rows, docs):
    t = Tokenizer.from_file(PATH)
    at = 0
    order = sorted(((r.doc_id is not None, r.doc_id or 0, r.h, r.text or "") for r in docs))
    got = sorted(rows, key=lambda r: r.start)
    assert len(got) == len(order)
    for r, (_, d, _, text) in zip(got, order):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert ((r.doc_id or 0), r.start, r.n_tokens, r.ids_crc32) == (d, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_files_hold_every_document_in_order(spark, documents):
    docs = documents.select("doc_id", "text")
    check(B.token_files(docs.repartition(5), PATH).collect(), hashed(docs))


def test_edges(spark, edges, nothing):
    check(B.token_files(edges, PATH).collect(), hashed(edges))
    assert B.token_files(nothing, PATH).count() == 0


def test_added_token_literals(spark):
    texts = ["x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|>b c", "plain words after", "<|endoftext| > x <|endoftext", None, "tail <|endoftext|><|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    rows = B.token_files(docs, PATH).collect()
    check(rows, hashed(docs))
    assert [r.n_tokens for r in sorted(rows, key=lambda r: r.doc_id)][:2] == [5, 2]


def test_ids_of_odd_spaces_equal_the_library():
    units, library = UnitIds.get(PATH), Tokenizer.from_file(PATH)
    for text in fuzzed(20_000, 9):
        assert units.text(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_ids_must_fit(spark):
    assert B.width(UnitIds.get(PATH).size) == 16
    with pytest.raises(ValueError, match="more than 4 bits"):
        B.pack(np.array([3, 16], np.uint32), 4)


def test_equal_and_null_ids_are_dealt_out(spark):
    docs = spark.createDataFrame([(None, f"text {i}") for i in range(300)] + [(7, f"other {i}") for i in range(300)] + [(7, "same")] * 50, "doc_id bigint, text string")
    rows = B.token_files(docs, PATH).collect()
    check(rows, hashed(docs))
