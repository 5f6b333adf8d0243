"""A folder of markdown files kept in step with its passages: new, changed and vanished files.

Each run compares the files with the state of the last one, (source, digest, version) a document, and makes passages only of texts that
it lacks.  They are written to a folder of the run's version; then the new state is written, which commits the run: readers follow
the newest complete state.  A run that dies before that leaves a folder that no state points at, and the next one, of the same version,
replaces it.

Of files with equal texts, under any names, the first by name counts; when it changes or vanishes, the next takes its place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmill.config import ChunkConfig
from docmill.operators import chunks
from docmill.sources.readers import markdown

_STATE = "source string, digest string, version bigint"


def _versions(spark: SparkSession, target: str) -> list[int]:
    """The committed states, oldest first: one folder a run."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/state")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    found = [x.getPath() for x in files.listStatus(root)]
    return sorted(int(p.getName().split("=")[1]) for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def state(spark: SparkSession, target: str) -> DataFrame:
    """(source, digest, version) of the documents that count now; their passages are those of that version."""
    versions = _versions(spark, target)
    return spark.read.schema(_STATE).parquet(f"{target}/state/run={versions[-1]}") if versions else spark.createDataFrame([], _STATE)


def changes(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(source, digest, op, version): ``add``, ``change``, ``keep`` or ``delete`` for each document that counts now or did."""
    now = docs.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("digest")).agg(F.min("source").alias("source"))
    old = known.select("source", F.col("digest").alias("_was"), "version")
    both = now.join(old, "source", "full_outer")
    op = F.when(F.col("digest").isNull(), "delete").when(F.col("_was").isNull(), "add").when(F.col("digest") != F.col("_was"), "change").otherwise("keep")
    return both.select("source", F.coalesce("digest", "_was").alias("digest"), op.alias("op"), "version")


def sync(spark: SparkSession, folder: str, target: str, config: ChunkConfig = ChunkConfig()) -> dict[str, int]:
    """Bring ``target`` in step with ``folder``; returns how many documents were added, changed, kept and deleted."""
    versions = _versions(spark, target)
    version = versions[-1] + 1 if versions else 0
    docs = markdown(spark, folder).select("source", "text")
    # The plan of the run, two short strings a document, is written: what follows must see one state of the folder.
    path = f"{target}/plan"
    changes(docs, state(spark, target)).write.mode("overwrite").parquet(path)
    plan = spark.read.parquet(path)
    fresh = plan.where("op IN ('add', 'change')").select("source", "digest")
    made = docs.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256)).join(fresh, ["source", "digest"], "left_semi").select("source", "text")
    chunks.passages(made, config).write.mode("overwrite").parquet(f"{target}/passages/version={version}")
    now = plan.where("op <> 'delete'").select("source", "digest", F.when(F.col("op") == "keep", F.col("version")).otherwise(version).cast("bigint").alias("version"))
    now.write.mode("overwrite").parquet(f"{target}/state/run={version}")
    counts = {r.op: r["count"] for r in plan.groupBy("op").count().collect()}
    return {op: counts.get(op, 0) for op in ("add", "change", "keep", "delete")}


def passages(spark: SparkSession, target: str) -> DataFrame:
    """The passages of the documents that count now."""
    kept = state(spark, target)
    return spark.read.parquet(f"{target}/passages").withColumn("version", F.col("version").cast("bigint")).join(kept.select("source", "version"), ["source", "version"], "left_semi").drop("version")
