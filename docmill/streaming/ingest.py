"""Incremental ingest: new markdown files become passages once, by content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.config import ChunkConfig
from docmill.operators import chunks
from docmill.sources.readers import file_name, stem


def markdown_stream(spark: SparkSession, folder: str) -> DataFrame:
    """(source, text, arrived) of files as they appear."""
    rows = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.md").load(folder)
    return rows.select(stem(file_name()).alias("source"), F.regexp_replace("value", "\r\n?", "\n").alias("text"), F.col("_metadata.file_modification_time").alias("arrived"))


def ingest(spark: SparkSession, folder: str, target: str, checkpoint: str, horizon: str = "30 days", config: ChunkConfig = ChunkConfig()) -> None:
    """Process what is there and stop.  The same text within ``horizon`` is taken once: its digest is the only state, and the
    watermark lets it go."""
    fresh = markdown_stream(spark, folder).withColumn("digest", F.sha2(F.col("text").cast("binary"), 256)).withWatermark("arrived", horizon).dropDuplicatesWithinWatermark(["digest"])

    def write(batch: DataFrame, number: int) -> None:
        chunks.passages(batch, config).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)

    query = fresh.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def lines_per_minute(events: DataFrame, window: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Windowed counts of an event stream (ts, event_type) with a watermark for late rows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"))


