"""N-gram Jaccard join by chosen paths.

Links are pairs of different texts whose sets of distinct five-word shingles have a Jaccard similarity of ``THRESHOLD`` or
more.  Equal texts are collapsed first, so copies never meet each other.

1. Each distinct text gets a signature of ``K`` minimum hashes, the sampled shared tokens that paths branch on.
2. A run starts from a root that holds all sets.  A bucket chooses each of the K coordinates with probability 1 / (THRESHOLD K), by a hash of its
   path; sets that agree on a chosen coordinate go to a common child.  A bucket of at most ``SMALL`` sets is a leaf; a larger one
   splits again, down to ``DEPTH`` levels.  Runs repeat until a pair at the threshold is met with ``RECALL``
   probability even if every bucket on its way had to be split to the last level.
3. Leaves are brute-forced on signatures: pairs with at least ``AGREE`` equal coordinates (over four standard deviations below
   the threshold) connect.  A leaf that is still large is dealt out as pairs of blocks of about ``BLOCK`` sets.  Only star edges leave a task.
4. Connected sets form candidate clusters; each is verified exactly, all pairs on full shingle sets by blocked matrix products, in
   pairs of blocks of about ``VERIFY_BLOCK`` where it is large.  This finds links within a cluster that no leaf held, too.  A task returns counts of links
   and star edges, never pairs.

Defined results: one row for each input row: doc_id, class_id (least doc_id of its connected class), n_links (different
texts linked to its text), n_copies (other rows of the same text).  A null text is the empty text.  Texts without words
have no shingles and link to nothing, so their class is their copies; fewer than five words are one shingle.  Rows with
null doc_id take part; a class of such rows only has a null class_id.  Extra columns are ignored by ``join`` and kept by
``keep_one``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import written
from docmill.llm.components import components
from docmill.llm.shingles import hashed, mix

THRESHOLD = 0.8
K = 64
AGREE = 36
SMALL = 128
BLOCK = 1024
VERIFY_BLOCK = 512
DEPTH = 3
RECALL = 0.999
_GOLD = 0x9E3779B97F4A7C15


def met(threshold: float, depth: int, n: int) -> float:
    """Chance that a pair at the threshold meets in a leaf of one of ``n`` runs, all its buckets split ``depth`` times.

    Its signature agrees in Binomial(K, threshold) coordinates, the same in every run; under AGREE it isn't connected."""
    total = 0.0
    for agree in range(AGREE, K + 1):
        q = 1.0
        for _ in range(depth):
            q = 1 - (1 - q / (threshold * K)) ** agree
        total += math.comb(K, agree) * threshold**agree * (1 - threshold) ** (K - agree) * (1 - (1 - q) ** n)
    return total


def runs(threshold: float = THRESHOLD, depth: int = DEPTH, recall: float = RECALL) -> int:
    """Fewest runs that reach the target recall."""
    return next(n for n in range(1, 1000) if met(threshold, depth, n) >= recall)


_FACTORS = mix(np.arange(1, K + 1, dtype=np.uint64) * np.uint64(_GOLD)) | np.uint64(1)


def signatures(bounds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """uint32 minimum hashes (rows x K) of rows without empty sets."""
    out = np.empty((len(bounds) - 1, K), np.uint32)
    for k in range(K):
        out[:, k] = np.minimum.reduceat((hashes * _FACTORS[k]) >> np.uint64(32), bounds[:-1])
    return out


def children(paths: np.ndarray, sigs: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child path) of every chosen coordinate of each row's path."""
    coordinate = np.arange(K, dtype=np.uint64)
    picks = mix(mix(paths)[:, None] + coordinate[None, :] * np.uint64(_GOLD))
    row, c = np.nonzero(picks < np.uint64(int(2.0**64 / (threshold * K))))
    return row, mix(picks[row, c] ^ mix(sigs[row, c].astype(np.uint64) + np.uint64(_GOLD)))


def _node(text) -> F.Column:
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16)


def _nodes(docs: DataFrame) -> DataFrame:
    """doc_id, node, text of each row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _node(text).alias("node"), text.alias("text"))


def _sketch(nodes: DataFrame) -> DataFrame:
    """(node, sig) of every distinct text that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for b in batches:
            names = b.column(0).to_pylist()
            new = []
            for r, x in enumerate(names):
                if x not in met:
                    met.add(x)
                    new.append(r)
            if len(met) > 500_000:
                met.clear()
            b = b.take(pa.array(new, pa.int64()))
            for i, n, bounds, h in hashed(b.column(1)):
                full = np.flatnonzero(np.diff(bounds))
                if len(full):
                    sig = signatures(np.append(bounds[:-1][full], bounds[-1]), h)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(full + i)), pa.array([s.tobytes() for s in sig], pa.binary())], ["node", "sig"])

    return nodes.select("node", "text").mapInArrow(run, "node binary, sig binary").groupBy("node").agg(F.first("sig").alias("sig"))


def _split(rows: DataFrame, threshold: float) -> DataFrame:
    """(path, node) children of (path, node, sig) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sigs = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint32).reshape(-1, K)
                row, path = children(b.column(0).to_numpy().view(np.uint64), sigs, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), b.column(1).take(pa.array(row))], ["path", "node"])

    return rows.select("path", "node", "sig").mapInArrow(run, "path bigint, node binary").distinct()


def _roots(sketch: DataFrame, n: int, threshold: float) -> DataFrame:
    """(path, node) at the first level of all runs."""
    starts = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = b.num_rows
            if m:
                sigs = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(-1, K)
                for s in starts:
                    row, path = children(np.full(m, s, np.uint64), sigs, threshold)
                    yield pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), b.column(0).take(pa.array(row))], ["path", "node"])

    return sketch.select("node", "sig").mapInArrow(run, "path bigint, node binary")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal first ``keys`` columns, which must be adjacent; a run is bounded by its maker."""
    key, held = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[:keys] != key:
                if held:
                    yield key, held
                key, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield key, held


def _labels(near: np.ndarray) -> np.ndarray:
    """Least index of each row's component under the symmetric relation ``near``."""
    label = np.arange(len(near))
    while True:
        new = np.where(near, label[None, :], len(near)).min(axis=1)
        new = np.minimum(new, label)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _dealt(rows: DataFrame, key: str, size: str, block: int) -> DataFrame:
    """Rows of groups of any size as pairs of blocks: (key, i, j, side, ...); a group of at most ``block`` rows is the block pair (0, 0)."""
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("own", own)
    pairs = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("*", pairs)
    return rows.select(key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("side"), *[c for c in rows.columns if c not in (key, "own", "other", "blocks", size)])


def candidate_edges(sketch: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Star edges (a, b) between sets that a leaf holds and whose signatures agree."""
    frontier = _roots(sketch, runs(threshold), threshold)
    small, large = None, None
    for level in range(1, DEPTH + 1):
        frontier = written(frontier, "paths")
        sizes = frontier.groupBy("path").agg(F.count("*").alias("size")).where("size > 1")
        held = written(frontier.join(sizes, "path"), "buckets")
        leaf = held.where(F.col("size") <= SMALL)
        small = leaf if small is None else small.union(leaf)
        large = held.where(F.col("size") > SMALL)
        if level == DEPTH or large.isEmpty():
            break
        frontier = _split(large.join(sketch, "node"), threshold)
    # Runs meet the same pairs again: leaves with the same members are one.  A member list has at most SMALL entries.
    lists = small.groupBy("path").agg(F.sort_array(F.collect_list("node")).alias("members")).select("members").distinct()
    leaves = lists.select(F.xxhash64("members").alias("path"), F.explode("members").alias("node")).withColumn("size", F.lit(1).cast("bigint"))
    rows = _dealt(leaves.union(large.select("path", "node", "size")).join(sketch, "node"), "path", "size", BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for _, rows in _groups(batches, 3):
            if len(rows) > 1:
                sigs = np.frombuffer(b"".join([r[2] for r in rows]), np.uint32).reshape(-1, K)
                near = np.zeros((len(rows), len(rows)), np.uint8)
                for k in range(K):
                    near += sigs[:, k, None] == sigs[None, :, k]
                label = _labels(near >= AGREE)
                for r in np.flatnonzero(label != np.arange(len(rows))):
                    a.append(rows[r][1])
                    b.append(rows[label[r]][1])
            if len(a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    placed = rows.select("path", "i", "j", "side", "node", "sig").repartition("path", "i", "j").sortWithinPartitions("path", "i", "j")
    return placed.mapInArrow(run, "a binary, b binary")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of all pairwise intersections."""
    n = len(sets)
    every = np.concatenate(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    value, place, count = np.unique(every, return_inverse=True, return_counts=True)
    use = count[place] > 1  # a shingle of one set meets no other
    column = np.cumsum(count > 1) - 1
    row, column = row[use], column[place[use]]
    out = np.zeros((n, n), np.float32)
    width = 4096
    by = np.argsort(column, kind="stable")
    row, column = row[by], column[by]
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, z = np.searchsorted(column, (lo, lo + width))
        block = np.zeros((n, min(width, int(column[z - 1]) - lo + 1)), np.float32)
        block[row[a:z], column[a:z] - lo] = 1
        out += block @ block.T
    return out


def _verified(rows: DataFrame, threshold: float) -> DataFrame:
    """(node, root, links, whole) from (cluster, i, j, side, node, text): exact links within each pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), rows in _groups(batches, 3):
            rows = list({r[1]: r for r in rows}.values())  # rows with equal doc_id and text
            sets = []
            for _, _, bounds, h in hashed(pa.array([r[2] for r in rows], pa.string())):
                sets += [np.unique(h[bounds[r] : bounds[r + 1]]) for r in range(len(bounds) - 1)]
            size = np.array([len(s) for s in sets], np.float64)
            both = overlaps(sets).astype(np.float64)
            # |A and B| >= t |A or B|, with a margin for the product's rounding only
            near = (both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9) & (both > 0)
            side = np.array([r[0] for r in rows])
            if i != j:
                near &= side[:, None] != side[None, :]
            np.fill_diagonal(near, False)
            label = _labels(near | np.eye(len(rows), dtype=bool))
            names = [r[1] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array([names[k] for k in label], pa.binary()), pa.array(near.sum(axis=1).astype(np.int64)), pa.array(np.array([r[3] for r in rows], bool))],
                ["node", "root", "links", "whole"],
            )

    placed = rows.select("cluster", "i", "j", "side", "node", "text", "whole").repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return placed.mapInArrow(run, "node binary, root binary, links bigint, whole boolean")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """((doc_id, node) of each row, (node, class_id, n_links, n_copies) of each distinct text)."""
    nodes = _nodes(docs)
    sketch = written(_sketch(nodes), "sketch")
    clusters = components(candidate_edges(sketch, threshold)).withColumnRenamed("root", "cluster")
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("size"))
    members = nodes.select("doc_id", "node")
    texts = members.groupBy("node").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows"))
    # One row of each clustered text: by node and its least doc_id, so that copies don't meet in one task.
    none = F.lit(-(1 << 63))
    wanted = clusters.join(sizes, "cluster").join(texts.select("node", F.coalesce("rep", none).alias("rep")), "node")
    met = nodes.withColumn("rep", F.coalesce("doc_id", none)).join(wanted, ["node", "rep"])
    # Rows that repeat, or copies without ids, are one: each task keeps one a node before the shuffle.
    picked = met.groupBy("node", "cluster", "size").agg(F.first("text").alias("text"))
    rows = _dealt(picked.withColumn("whole", F.col("size") <= VERIFY_BLOCK).select("cluster", "size", "node", "text", "whole"), "cluster", "size", VERIFY_BLOCK)
    found = written(_verified(rows, threshold), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    one = found.where("whole").select("node", "root")
    many = found.where("NOT whole AND node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = one if many.isEmpty() else one.union(components(many))
    labelled = texts.join(roots, "node", "left").join(links, "node", "left").select("node", "rep", "rows", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    labelled = written(labelled, "classes")
    least = labelled.groupBy("root").agg(F.min("rep").alias("class_id"))
    return members, labelled.join(least, "root").select("node", "root", "class_id", "n_links", (F.col("rows") - 1).alias("n_copies"), "rep")


def join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies) of each row."""
    members, labelled = classes(docs, threshold)
    return members.join(labelled, "node").select("doc_id", "class_id", "n_links", "n_copies")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class: that of the least doc_id (of equal rows, one; of a class with null ids only, one)."""
    _, labelled = classes(docs, threshold)
    none = F.lit(-(1 << 63))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(whole.alias("r"), F.coalesce(F.col("doc_id").cast("bigint"), none).alias("id"), _node(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("node"))
    winners = labelled.where(F.col("rep").eqNullSafe(F.col("class_id")))
    # Equal doc_ids of different texts in a class: one.  The root tells classes apart, as two may share a least id or have none.
    winners = winners.groupBy("root", F.coalesce("class_id", none).alias("id")).agg(F.min("node").alias("node"))
    return rows.join(winners, ["id", "node"]).groupBy("id", "node").agg(F.min_by("r", F.to_json("r")).alias("r")).select("r.*")
