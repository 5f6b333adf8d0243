"""Dense global numbers in an order, without a global sort in one task."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scratch(df: DataFrame, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is absent, below ``/tmp/docmill-checkpoints`` on one machine; a cluster
    must have it."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{(base or '/tmp/docmill-checkpoints').rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later passes don't repeat the work, and lost executors lose nothing."""
    path = scratch(df, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_order(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows dealt out by ranges of ``keys``, nulls first, and sorted in their partitions: partition after partition they are in order.

    Rows that tie are told apart by where they stand in the input, so that equal keys don't gather in one partition."""
    placed = df.withColumn("_tie", F.monotonically_increasing_id())
    order = [*[F.col(k) if isinstance(k, str) else k for k in keys], F.col("_tie")]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie")


def dense(df: DataFrame, name: str) -> DataFrame:
    """Adds ``name``: 1, 2, ... in the order of partitions and of the rows within them.

    Rows are written with their place; what goes to one task is one row a partition."""
    placed = written(df.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part, own = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    totals = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    base = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = F.broadcast(totals.select("_part", base.alias("_base")))
    return placed.withColumn("_part", part).join(bases, "_part").withColumn(name, F.col("_base") + own + 1).drop("_part", "_base", "_at")
