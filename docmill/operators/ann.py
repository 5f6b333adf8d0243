"""Approximate cosine search beyond exact blocks: an inverted file of coarse lists with product-quantised residuals, and exact re-ranking.

* ``train``: coarse centroids, and code words of the residuals' parts, by k-means over at most about ``SAMPLE`` rows with the least hashes, the bound of what
  comes to the driver.
* ``index``: every row goes to its nearest centroid's list, with one byte for each part of its residual.
* ``search``: a query probes its nearest lists; the dot product with a row is that with the centroid and one table look-up for each
  part.  Queries go out in blocks of about ``BLOCK``, the bound of each broadcast; each task sends ``refine`` rows a query at most.  The best
  ``refine`` of a query are joined to their vectors and ranked by the exact similarity.

A row without a vector, or with a vector of zeros, isn't found; ties go to the smaller vec_id."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docmill.operators.ordinals import written
from docmill.operators.vectors import STEP, Best, cosine

SAMPLE = 20_000
BLOCK = 2048
ROUNDS = 12
INDEXED = "list int, vec_id bigint, code binary"


@dataclass
class Coder:
    centroids: np.ndarray  # lists x dim
    words: np.ndarray  # parts x words x width of a part


def _unit(column: pa.Array) -> np.ndarray:
    m = np.stack(column.to_numpy(zero_copy_only=False)).astype(np.float32)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-30)


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The nearest centroid of each row, in steps that bound the distances held at once."""
    half = (centroids * centroids).sum(axis=1) / 2
    out = np.empty(len(x), np.int64)
    for lo in range(0, len(x), 4096):
        out[lo : lo + 4096] = np.argmax(x[lo : lo + 4096] @ centroids.T - half, axis=1)
    return out


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k centroids; an empty one is put on a random row."""
    centroids = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(ROUNDS):
        own = nearest(x, centroids)
        total, n = np.zeros_like(centroids), np.bincount(own, minlength=k)
        np.add.at(total, own, x)
        centroids = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], x[rng.integers(0, len(x), k)]).astype(np.float32)
    return centroids


def _vectors(rows: DataFrame) -> DataFrame:
    return rows.select("vec_id", "embedding").where("embedding IS NOT NULL").where(F.exists("embedding", lambda v: v != 0))


def train(rows: DataFrame, lists: int, parts: int, seed: int = 3) -> Coder:
    """``parts`` must divide the vectors' length."""
    held = _vectors(rows).withColumn("_h", F.xxhash64("vec_id"))
    share = max(1, held.count() // SAMPLE)
    x = _unit(held.where(F.pmod("_h", F.lit(share)) == 0).orderBy("_h", "vec_id").limit(2 * SAMPLE).select("embedding").toArrow()["embedding"].combine_chunks())
    rng = np.random.default_rng(seed)
    centroids = kmeans(x, lists, rng)
    rest = (x - centroids[nearest(x, centroids)]).reshape(len(x), parts, -1)
    return Coder(centroids, np.stack([kmeans(rest[:, m], 256, rng) for m in range(parts)]))


def index(rows: DataFrame, coder: Coder) -> DataFrame:
    """(list, vec_id, code) of every row, written in the order of lists."""
    shared = rows.sparkSession.sparkContext.broadcast(coder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for b in batches:
            if b.num_rows:
                x = _unit(b.column(1))
                own = nearest(x, c.centroids)
                rest = (x - c.centroids[own]).reshape(len(x), len(c.words), -1)
                codes = np.stack([nearest(rest[:, m], c.words[m]) for m in range(len(c.words))], axis=1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), b.column(0), pa.array([r.tobytes() for r in codes], pa.binary())], ["list", "vec_id", "code"])

    # A list that a third of all rows share is dealt out by the range of its ids, too.
    made = _vectors(rows).mapInArrow(run, INDEXED)
    return written(made.repartitionByRange("list", "vec_id").sortWithinPartitions("list"), "ivf")


def search(queries: DataFrame, indexed: DataFrame, rows: DataFrame, coder: Coder, k: int, probes: int = 8, refine: int = 64) -> DataFrame:
    """(query_id, vec_id, score, rank): about the k nearest rows of each query, itself aside; scores are exact."""
    spark, held = rows.sparkSession, _vectors(queries)
    blocks = -(-held.count() // BLOCK)
    near = spark.createDataFrame([], "query_id bigint, vec_id bigint, score float")
    for k_block in range(blocks):
        t = held.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == k_block).toArrow().combine_chunks()
        if not t.num_rows:
            continue
        q = _unit(t["embedding"].combine_chunks())
        coarse = q @ coder.centroids.T
        half = (coder.centroids * coder.centroids).sum(axis=1) / 2
        probed = np.argsort(half - coarse, axis=1, kind="stable")[:, :probes]
        asks = {int(c): np.flatnonzero((probed == c).any(axis=1)) for c in np.unique(probed)}
        # queries x parts x words: what each code word adds
        tables = np.einsum("qmw,mcw->qmc", q.reshape(len(q), len(coder.words), -1), coder.words).astype(np.float32)
        shared = spark.sparkContext.broadcast((t["vec_id"].to_numpy(), coarse.astype(np.float32), asks, tables))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            names, coarse, asks, tables = shared.value
            best = Best(len(names), refine, np.float32)
            for b in batches:
                place, ids = b.column(0).to_numpy(), b.column(1).to_numpy()
                codes = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint8).reshape(len(ids), -1)
                for c in np.unique(place).tolist():
                    who, held = asks.get(c, ()), np.flatnonzero(place == c)
                    for lo in range(0, len(held) if len(who) else 0, STEP):
                        rows_of = held[lo : lo + STEP]
                        score = np.repeat(coarse[who, c][:, None], len(rows_of), axis=1)
                        for m in range(codes.shape[1]):
                            score += tables[who, m][:, codes[rows_of, m]]
                        score[names[who][:, None] == ids[rows_of][None, :]] = -np.inf
                        best.add(who, ids[rows_of], score)
            yield best.batch(names)

        near = near.union(indexed.where(F.col("list").isin([int(c) for c in asks])).select("list", "vec_id", "code").mapInArrow(run, "query_id bigint, vec_id bigint, score float"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    few = near.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= refine).select("query_id", "vec_id")
    both = few.join(rows.select("vec_id", "embedding"), "vec_id").join(queries.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("_q")), "query_id")
    scored = both.select("query_id", "vec_id", F.round(cosine(F.col("_q"), F.col("embedding")), 5).alias("score"))
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
