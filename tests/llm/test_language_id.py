import math
from collections import Counter

import numpy as np
import pyarrow as pa

from docmill.llm import language_id as L
from docmill.llm.common import utf8


def bits(train, text):
    counts = [Counter() for _ in range(L.ORDER + 1)]
    for t in train:
        b = b"\n" * L.ORDER + t.encode()
        for i in range(L.ORDER, len(b)):
            for k in range(L.ORDER + 1):
                counts[k][b[i - k : i + 1]] += 1
    total, distinct = Counter(), Counter()
    for c in counts:
        for g, n in c.items():
            total[g[:-1], len(g)] += n
            distinct[g[:-1], len(g)] += 1
    out, b = 0.0, b"\n" * L.ORDER + text.encode()
    for i in range(L.ORDER, len(b)):
        for k in range(L.ORDER, -1, -1):
            g = b[i - k : i + 1]
            n, d = total[g[:-1], len(g)], distinct[g[:-1], len(g)]
            if counts[k][g]:
                out -= math.log2(counts[k][g] / (n + d))
                break
            if n:
                out -= math.log2(d / (n + d))
        else:
            out += 8
    return out


def test_code_lengths_equal_direct_escapes():
    train = {"x": ["the cat sat", "on the mat the"], "y": ["el gato está", "sobre la mesa é"]}
    lang, gram, n = [], [], []
    for name, texts in train.items():
        at, data = utf8(pa.array(texts))
        g, c = np.unique(L.grams(at, data), return_counts=True)
        lang += [name] * len(g)
        gram.append(g)
        n.append(c)
    model = L.Model(lang, np.concatenate(gram).astype(np.int64), np.concatenate(n))
    for text in ("the gato", "é", "zz", "cat on mesa", "\n\n\nthe", "漢字 ÿ"):
        at, data = utf8(pa.array([text]))
        assert np.allclose(model.costs(L.grams(at, data)).sum(axis=0), [bits(train["x"], text), bits(train["y"], text)], atol=1e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = L.identify(docs, L.train(docs.where(~L.held_out()))).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 200
    assert (got.lang_pred == got.lang).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_edges(spark, edges, nothing):
    model = L.train(edges.where(~L.held_out()))
    rows = L.identify(edges, model).collect()
    assert len(rows) == edges.count()
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {1, 2, 3, 6}
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert sum(r.doc_id == 8 for r in rows) == 2
    assert {r.lang_pred for r in L.identify(edges, L.train(nothing)).collect()} == {"und"}
    assert L.identify(nothing, model).count() == 0
    kept = L.keep(edges, model, "guess")
    assert kept.columns == [*edges.columns, "guess"]
    # With these few learned rows, signs that none of them has are no learned language's, either.
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.lang_pred != "und" and r.doc_id != 5)


def test_long_texts_are_learnt_from_and_counted_in_parts(spark, monkeypatch):
    long = {"xx": "alpha beta gamma delta " * 4000, "yy": "uno dos tres cuatro é " * 4000}
    rows = [(i, f"{long[lang]}{i}", lang) for i in range(12) for lang in long]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = L.train(docs)
    got = L.identify(docs, model).collect()
    assert [r.lang_pred for r in sorted(got, key=lambda r: (r.doc_id, r.lang_pred))] == ["xx", "yy"] * 12
    text = long["yy"][:5000]
    at, data = utf8(pa.array([text]))
    whole = L.grams(at, data)
    assert (np.concatenate([key for _, key in L.pieces(at, data, 0, 1, 700)]) == whole).all()
    assert np.allclose(model.predict(pa.array([text]))[2], model.costs(whole).sum(axis=0).min() / len(data))


def test_equal_rows_and_ids_lose_no_language(spark):
    rows = [(1, "only one text of this language", "aa")] * 5000 + [(2, f"words of one id {i}", "bb") for i in range(5000)] + [(i, f"outros textos {i}", "cc") for i in range(20)]
    model = L.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert model.langs == ["aa", "bb", "cc"]


def test_only_the_model_tells_what_it_rejects(spark):
    rows = [(i, f"plain words of a learned language come and go, number {i} of many", "en") for i in range(200)]
    model = L.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    texts = ["other plain words of many numbers", "汉字 " * 40, "русский текст из многих слов " * 5, "Q", "zq", "漢", "token = 9dd3c80004c73dc10a and words come", "1234 5678"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert sorted(r.doc_id for r in L.keep(docs, model).collect()) == [0, 3, 4, 5, 6]
