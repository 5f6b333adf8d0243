import numpy as np
from pyspark.sql import functions as F

from docmill import catalog
from docmill.operators import ann, vectors


def test_recall_of_the_query_against_exact_search(spark):
    d = "/root/testdata/sf0.1"
    exact = {(r.query_id, r.vec_id): r.score for r in catalog.QUERIES["q_cosine_topk"](spark, d).collect()}
    found = {(r.query_id, r.vec_id): r.score for r in catalog.QUERIES["q_ivf_topk"](spark, d).collect()}
    assert len(found) == len(exact)
    recall = len(found.keys() & exact.keys()) / len(exact)
    assert recall >= 0.9, recall
    assert all(abs(found[k] - exact[k]) < 2e-5 for k in found.keys() & exact.keys())


def test_every_row_is_indexed_and_probing_all_lists_is_exact(spark):
    rng = np.random.default_rng(1)
    data = [(i, rng.standard_normal(16).astype(float).tolist()) for i in range(700)] + [(700, None), (701, [0.0] * 16), (702, [1.0] * 16), (703, [1.0] * 16)]
    rows = spark.createDataFrame(data, "vec_id bigint, embedding array<float>").repartition(5)
    coder = ann.train(rows, 8, 4)
    indexed = ann.index(rows, coder)
    assert sorted(r.vec_id for r in indexed.collect()) == [*range(700), 702, 703]
    queries = rows.where("vec_id % 50 = 0 OR vec_id >= 700")
    some = rows.where("embedding IS NOT NULL AND vec_id <> 701")
    want = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in vectors.top_k(queries.where("vec_id <> 701"), some, 4).collect()}
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in ann.search(queries, indexed, rows, coder, 4, probes=8, refine=800).collect()}
    assert got.keys() == want.keys() and all(abs(got[k][1] - want[k][1]) < 2e-5 for k in want) and got[702, 1] == (703, 1.0)


def test_few_rows_and_none(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, [0.0, 1.0])], "vec_id bigint, embedding array<float>")
    coder = ann.train(rows, 4, 2)
    indexed = ann.index(rows, coder)
    assert [(r.vec_id, r["rank"]) for r in ann.search(rows.where("vec_id = 1"), indexed, rows, coder, 5).orderBy("rank").collect()] == [(2, 1), (3, 2)]
    assert ann.search(rows.limit(0), indexed, rows, coder, 5).count() == 0
    assert ann.search(rows, indexed.where(F.lit(False)), rows, coder, 5).count() == 0
