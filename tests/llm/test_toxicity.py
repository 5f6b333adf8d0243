import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from docmill.llm import toxicity as T


def test_held_out_detection(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    truth = labels.where(out).select("doc_id", F.col("toxic").alias("label"))
    got = T.predict(docs, T.train(docs, labels.where(~out))).join(truth, "doc_id").toPandas()
    # About an eighth of the toxic labels are on texts without any toxic word.
    assert got.toxic[got.label == 1].mean() > 0.8
    assert got.toxic[got.label == 0].mean() < 0.01


def test_expected_severity_rises_with_grade(spark):
    texts = ["fine words in a calm text number %d" % i for i in range(60)] + ["a rude idiot text number %d" % i for i in range(60)] + ["idiot scum trash moron text number %d" % i for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i // 60) for i in range(180)], "doc_id bigint, toxic int")
    model = T.train(docs, labels)
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    got = {r.doc_id: r for r in T.predict(docs, model).collect()}
    means = [np.mean([got[i].severity for i in range(a, a + 60)]) for a in (0, 60, 120)]
    assert means[0] < 0.2 < means[1] < 1.4 < means[2]
    assert [got[i].grade for i in (3, 63, 123)] == [0, 1, 2] and [got[i].toxic for i in (3, 63, 123)] == [False, True, True]


def test_sparse_features_equal_counting():
    texts = pa.array(["a b a", None, "", "ß" * 3, "b a"])
    rows = [(i, k, n) for first, m, b, f, v in T.sparse(texts) for i in range(m) for k, n in zip(f[b[i] : b[i + 1]], v[b[i] : b[i + 1]])]
    by = {i: dict((k, n) for j, k, n in rows if j == i) for i in range(5)}
    assert len(by[0]) == 2 and sorted(by[0].values()) == [1.0, 1 + np.log(2)]
    assert not by[1] and not by[2] and len(by[3]) == 2 and set(by[4]) == set(by[0])


def test_edges(spark, edges, nothing):
    labels = spark.createDataFrame([(7, 1), (7, 0), (8, 0), (None, 1), (5, None), (99, 1), (12, 0)], "doc_id bigint, toxic int")
    rows = T.predict(edges, T.train(edges, labels)).collect()
    assert len(rows) == edges.count() and all(0 <= r.severity <= 2 for r in rows)
    assert {r.severity for r in T.predict(edges, T.train(edges, labels.where("toxic = 0"))).collect()} == {0.0}
    assert {r.severity for r in T.predict(edges, T.train(nothing, labels)).collect()} == {0.0}
    assert T.predict(nothing, T.train(edges, labels)).count() == 0


def test_fit_is_a_maximum_of_the_likelihood():
    rng = np.random.default_rng(1)
    n, m = 400, 4
    x = rng.normal(size=(n, m))
    grade = np.digitize(x @ [1.0, -0.5, 0.0, 0.3] + rng.logistic(size=n), [-0.5, 1.0])
    model = T.fit(np.arange(n + 1) * m, np.tile(np.arange(m), n), x.ravel(), grade)

    def loss(w, t):
        above = np.hstack([np.ones((n, 1)), 1 / (1 + np.exp(-((x @ w)[:, None] - t[None, :]))), np.zeros((n, 1))])
        return -np.log(above[np.arange(n), grade] - above[np.arange(n), grade + 1]).mean() + T.DECAY / 2 * (w @ w)

    w, t = model.weights[:m].astype(float), model.thresholds
    best = loss(w, t)
    for k in range(m + 2):
        for d in (-0.05, 0.05):
            step = np.eye(m + 2)[k] * d
            assert loss(w + step[:m], t + step[m:]) > best


def test_repeated_ids_and_long_texts_are_learnt_once(spark):
    rows = [(i, f"calm words {i % 7}") for i in range(40)] + [(100 + i, f"rude scum {i % 7}") for i in range(40)] + [(3, "rude scum again")] * 500 + [(7, "word " * 200_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], int(r[0] >= 100)) for r in rows[:80]], "doc_id bigint, toxic int")
    got = {r.doc_id: r.toxic for r in T.predict(docs.limit(80), T.train(docs, labels)).collect()}
    assert all(got[100 + i] for i in range(40)) and not any(got[i] for i in range(40))


def plain_severity(text, model):
    """Severity and P(grade > 0) by plain loops over bytes, with the hashes spelt out."""
    whole = 1 << 64

    def mix(x):
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 % whole
        x ^= x >> 27
        x = x * 0x94D049BB133111EB % whole
        return x ^ x >> 31

    raw = (text or "").lower().encode()
    found = [mix(sum((c + 1) * pow(0x9E3779B97F4A7C15, k, whole) for k, c in enumerate(w)) % whole) for w in re.findall(rb"[0-9a-z_\x80-\xff]+", raw)]
    found += [mix((int.from_bytes(raw[k : k + 6], "big") + 1) % whole) for k in range(len(raw) - 5)]
    dot = sum(float(model.weights[f]) * (1 + math.log(n)) for f, n in Counter(h >> 44 for h in found).items())
    above = [1 / (1 + math.exp(-(dot - t))) for t in model.thresholds]
    return sum(above), above[0]


def test_predictions_equal_plain_loops(spark, edges):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = T.train(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in docs.where("doc_id % 9 = 0").collect()] + [(-k, r.text) for k, r in enumerate(edges.collect(), 1)]
    got = {r.doc_id: r for r in T.predict(spark.createDataFrame(rows, "doc_id bigint, text string"), model).collect()}
    for doc_id, text in rows:
        severity, first = plain_severity(text, model)
        assert abs(got[doc_id].severity - severity) < 1e-9 and abs(got[doc_id].p_toxic - first) < 1e-9 and got[doc_id].toxic == (got[doc_id].p_toxic >= 0.5)
