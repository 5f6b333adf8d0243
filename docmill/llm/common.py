"""Shared helpers: table access, shared scratch storage, and zero-copy views of Arrow text columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one vectorised step works on; longer single documents are a step of their own.
STEP_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor sees.

    Where the setting is absent it lies below ``/tmp/docmill-checkpoints`` on one machine; a cluster must have it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{(base or '/tmp/docmill-checkpoints').rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Cut lineage: write ``df`` as Parquet into the shared folder and read it back."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def forget(*frames: DataFrame) -> None:
    """Delete what ``written`` made of these frames: for what a later written result has taken up, so that no plan reads it again."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets int64 of n+1, data uint8) of a string or binary column, without copying; nulls have length 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind, n + 1, column.offset * kind().itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if column.null_count and np.any(np.diff(at)[np.asarray(column.is_null())]):
        return utf8(column.fill_null(b"" if pa.types.is_binary(column.type) else ""))
    return at, raw


def steps(at: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) whose text is at most ``most`` bytes, or one row."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, j
        i = j
