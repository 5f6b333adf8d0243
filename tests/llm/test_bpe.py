import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from docmill.llm import bpe
from docmill.llm.bpe import Engine, encode_decode

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def engine():
    return Engine.get(RANKS, PATTERN)


@pytest.fixture(scope="module")
def library(engine):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=engine.rank, special_tokens={})


def odd():
    random.seed(1)
    letters = "".join(random.choice("abcdefghijklmnopqrstuvwxyzABC") for _ in range(3000))
    runs = ["=" * 1000, "a" * 333, "aaab" * 200, "ab" * 150, "hahaha" * 40, letters]
    return [*runs, " \n\n x  y\tz  ", "", "x\x1cy \x1d z", "　é漢字" * 50, "  lead", "trail ", "ab " * 10, "\r\n \r\n", "it's WE'LL 's", "a b  c", "😀👍🏽 \x00\x01", "<|endoftext|>"]


def test_ids_equal_the_library_and_decode_exactly(engine, library, documents):
    texts = odd() + [r.text for r in documents.collect()]
    ids = engine.encode(texts)
    for text, x in zip(texts, ids):
        assert x.tolist() == library.encode_ordinary(text), text[:40]
    assert engine.decode(ids) == [t.encode() for t in texts]


def test_long_pieces_contract_as_one_by_one(engine, monkeypatch):
    pieces = [t.encode() for t in odd() if len(t) <= 600 and t]
    together = engine.encode_pieces(pieces)
    monkeypatch.setattr(bpe, "LONG", 10**9)
    assert engine.encode_pieces(pieces) == together


def test_edges(spark, edges, nothing, library):
    want = sorted((str(r.doc_id), len(x := library.encode_ordinary(r.text or "")), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in edges.collect())
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encode_decode(edges, RANKS, PATTERN).collect())
    assert got == want
    assert encode_decode(nothing, RANKS, PATTERN).count() == 0
    ids = bpe.encode_column(edges, RANKS, PATTERN)
    assert ids.columns == [*edges.columns, "token_ids", "decoded_sha256"]
    assert sorted(len(r.token_ids) for r in ids.collect()) == sorted(w[1] for w in want)


SPACES = [" ", "  ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", " \xa0 \xa0 ", *map(chr, (0x1680, 0x2000, 0x2028, 0x2029, 0x202F, 0x3000, 0x200B, 0x180E))]
WORDS = ["a", "the", "x1", "it's", "'", "!", "é", "漢", "12", "<|endoftext|>", "I'LL", "--", "\x00", "😀", "ab.cd", "\u0301"]


def fuzzed(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(SPACES) if rng.random() < 0.6 else rng.choice(WORDS) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_ids_of_odd_spaces_equal_the_library(engine, library):
    texts = fuzzed(20_000, 7)
    ids = engine.encode(texts)
    assert [x.tolist() for x in ids] == [library.encode_ordinary(t) for t in texts]
    assert engine.decode(ids) == [t.encode() for t in texts]


def test_long_words_take_time_in_proportion(engine, library):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzABC") for _ in range(100_000)), "=" * 100_000, "a" * 99_999, "hannah" * 15_000 + "x", "====_" * 20_000, "漢字" * 20_000]
    start = time.time()
    ids = engine.encode(words)
    assert time.time() - start < 30
    assert [x.tolist() for x in ids] == [library.encode_ordinary(w) for w in words]


def test_decoded_bytes_come_from_the_documents_own_ids(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id bigint, text string")
    a, b = Engine.get(RANKS, PATTERN).decode([np.array([1, 2], np.uint32)])[0], Engine.get(RANKS, PATTERN).decode([np.array([2, 1], np.uint32)])[0]
    assert a == b[::-1] and a != b
    row = bpe.encode_column(docs, RANKS, PATTERN).first()
    assert row.decoded_sha256 == hashlib.sha256(b"some words").hexdigest()
