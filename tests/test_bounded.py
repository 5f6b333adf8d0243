"""What a task holds, and what is shuffled, doesn't grow with the batch or the table."""

import numpy as np
from model import SF
from pyspark.sql import functions as F

from docmill import catalog
from docmill.operators import vectors


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_best_of_steps_equal_those_of_a_full_sort():
    rng = np.random.default_rng(5)
    score = np.round(rng.standard_normal((40, 1000)), 1)  # many ties
    score[3] = np.nan
    score[4, 5:] = -np.inf
    ids = rng.permutation(1000)
    best = vectors.Best(40, 7)
    for lo in range(0, 1000, 64):
        best.add(np.arange(40), ids[lo : lo + 64], score[:, lo : lo + 64])
        assert len(best.who) <= 40 * 7
    got = list(zip(best.who.tolist(), best.ids.tolist(), best.score.tolist()))
    want = [(q, int(i), float(s)) for q in range(40) for s, i in sorted(((s, i) for s, i in zip(score[q], ids) if np.isfinite(s)), key=lambda x: (-x[0], x[1]))[:7]]
    assert got == want


def test_a_task_sends_k_rows_a_query(spark):
    rows = spark.range(0, 3000, 1, 1).select(F.col("id").alias("vec_id"), F.array(F.sin("id").cast("float"), F.cos("id").cast("float")).alias("embedding"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        found = vectors.top_k(rows.where("vec_id < 2"), rows, 3).collect()
        sent = vectors.nearest(rows.where("vec_id < 2"), rows, 3).count()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sent == len(found) == 6


def counting():
    """An embedder whose vectors say how many of them there are."""
    import weakref

    class Counting:
        def __init__(self):
            self.live = weakref.WeakSet()

        def embed(self, text):
            class Vector(np.ndarray):
                __hash__ = object.__hash__

            v = np.zeros(1, np.float32).view(Vector)
            self.live.add(v)
            v[0] = len(self.live)
            return v

    return Counting


def test_an_embedding_task_holds_few_vectors(spark):
    rows = spark.range(0, 3000, 1, 1).select(F.col("id").cast("string").alias("text"))
    most = vectors.embed(rows, counting()).agg(F.max(F.col("vector")[0]).alias("m"), F.count("vector").alias("n")).first()
    assert most.n == 3000 and most.m <= 2 * vectors.EMBED_STEP


def test_blocks_and_sections_are_made_where_documents_lie(spark):
    """What is dealt out is the documents as they were read; nothing is sorted."""
    for name in ("q_blocks", "q_list_split", "q_table_split", "q_sections", "q_heading_path", "q_skip_reasons", "q_clean_text"):
        made = plan(catalog.QUERIES[name](spark, SF))
        assert made.count("Exchange hashpartitioning(doc_id") == made.count("Exchange") == 1, name
        assert "Window" not in made and "Sort" not in made, name
