"""Embedding runs that can be stopped and taken up again.

Rows are embedded in ranges of their id.  A range's vectors are written to a folder of its own, which replaces what an earlier run may have
left there; then the ledger gets a row for it.  A range counts from its ledger row on, so a run that dies at any point
loses at most the ranges of its last wave, and no row is kept twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.operators import vectors

RANGE = 10_000
WAVE = 256
_LEDGER = "model string, first bigint, n_rows bigint, n_errors bigint"


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """(model, first, n_rows, n_errors) of the finished ranges."""
    path = f"{target}/ledger"
    return spark.read.schema(_LEDGER).parquet(path) if _exists(spark, path) else spark.createDataFrame([], _LEDGER)


def run(rows: DataFrame, target: str, key: str = "row_id", model: str = "hashing-768", make: Callable = vectors.HashingEmbedder, size: int = RANGE, wave: int = WAVE) -> int:
    """Embed what ``target`` lacks of (key, text) rows, and return how many ranges that were.

    A range is unfinished if the ledger doesn't have it for this model with as many rows as there are now.  Waves of ``wave`` ranges are
    committed one after the other; the list of ranges, one number each, is all that the driver holds."""
    spark = rows.sparkSession
    placed = rows.withColumn("first", F.floor(F.col(key) / size) * size)
    done = ledger(spark, target).where(F.col("model") == model).groupBy("first").agg(F.max_by("n_rows", "n_rows").alias("n_rows"))
    there = placed.groupBy("first").agg(F.count("*").alias("n_rows"))
    todo = [r.first_ for r in there.join(done, ["first", "n_rows"], "left_anti").select(F.col("first").alias("first_")).orderBy("first_").toLocalIterator()]
    for i in range(0, len(todo), wave):
        held = placed.where(F.col("first").isin(todo[i : i + wave]))
        made = vectors.embed(held, make).withColumn("model", F.lit(model)).withColumn("vector", vectors.vf32_encode(F.col("vector")))
        made.repartition(F.col("first")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model", "first").parquet(f"{target}/vectors")
        finished = embedded(spark, target, model, todo[i : i + wave]).groupBy("model", "first").agg(F.count("*").alias("n_rows"), F.count("error").alias("n_errors"))
        finished.coalesce(1).write.mode("append").parquet(f"{target}/ledger")
    return len(todo)


def embedded(spark: SparkSession, target: str, model: str = "hashing-768", ranges: list[int] | None = None) -> DataFrame:
    """The rows of the finished ranges, or of ``ranges``."""
    found = spark.read.parquet(f"{target}/vectors").where(F.col("model") == model).withColumn("first", F.col("first").cast("bigint"))
    if ranges is not None:
        return found.where(F.col("first").isin(ranges))
    done = ledger(spark, target).where(F.col("model") == model).select("first").distinct()
    return found.join(done, "first", "left_semi")
