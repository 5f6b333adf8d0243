"""Connected components of an edge table by alternating large-star and small-star rounds, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import written


#: A node with more edges than this, and than a thousandth of all, is hot: there are fewer than 2000 of them.
HOT = 200


def _with_least(rows: DataFrame, least: DataFrame, edges: int) -> DataFrame:
    """``rows`` (u, v) with the m of their u.  Rows of hot nodes stay where they are and meet the few of these as a broadcast, so no
    star's centre gathers in one task; the others are joined."""
    hot = F.broadcast(least.where(F.col("n") > max(HOT, edges // 1000)).select("u", "m"))
    rest = rows.join(hot.select("u"), "u", "left_anti").join(least.select("u", "m"), "u")
    return rows.join(hot, "u").unionByName(rest)


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    return _with_least(both, least, n).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    moved = _with_least(down, least, n).where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the component's least node.  Each round's edges, at most as
    many as the input's, are written to the shared folder."""
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star")
    mark = _mark(edges)
    while mark[0]:
        large = written(_large_star(edges, mark[0]), "star")
        edges = written(_small_star(large, mark[0]), "star")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
