import pytest
from pyspark.sql import functions as F

from docmill.operators import embedding, vectors


def mortal():
    """An embedder that a certain text kills; made here so that it goes to the workers by value."""

    class Mortal(vectors.HashingEmbedder):
        def embed(self, text):
            if text == "die":
                raise SystemExit("killed")
            return super().embed(text)

    return Mortal


def rows(spark, n, die=None):
    text = F.when(F.col("id") % 7 == 0, " ").otherwise(F.concat(F.lit("word "), F.col("id") % 5))
    return spark.range(n).select(F.col("id").alias("row_id"), F.when(F.col("id") == (n if die is None else die), "die").otherwise(text).alias("text"))


def test_a_killed_run_is_taken_up_where_it_stopped(spark, tmp_path):
    target = str(tmp_path / "v")
    with pytest.raises(Exception):
        embedding.run(rows(spark, 1000, die=650), target, size=100, wave=2, make=mortal())
    finished = {r["first"] for r in embedding.ledger(spark, target).collect()}
    assert finished == {0, 100, 200, 300, 400, 500}
    assert embedding.embedded(spark, target).count() == 600
    assert embedding.run(rows(spark, 1000), target, size=100, wave=3, make=mortal()) == 4
    out = embedding.embedded(spark, target).collect()
    assert sorted(r.row_id for r in out) == list(range(1000))
    whole = {r.row_id: (r.vector and bytes(r.vector), r.error) for r in vectors.embed(rows(spark, 1000)).withColumn("vector", vectors.vf32_encode(F.col("vector"))).collect()}
    assert {r.row_id: (r.vector and bytes(r.vector), r.error) for r in out} == whole
    assert sum(r.n_errors for r in embedding.ledger(spark, target).collect()) == sum(e is not None for _, e in whole.values()) > 0


def test_only_what_is_new_is_computed(spark, tmp_path):
    target = str(tmp_path / "v")
    assert embedding.run(rows(spark, 250), target, size=100) == 3
    assert embedding.run(rows(spark, 250), target, size=100) == 0
    assert embedding.run(rows(spark, 420), target, size=100) == 3  # the range that grew, and two new ones
    assert sorted(r.row_id for r in embedding.embedded(spark, target).collect()) == list(range(420))
    assert embedding.run(rows(spark, 420), target, size=100, model="other") == 5
    assert embedding.embedded(spark, target).count() == embedding.embedded(spark, target, "other").count() == 420
    assert embedding.run(rows(spark, 0), target, size=100) == 0
