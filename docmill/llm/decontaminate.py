"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact containment.

An item contaminates a document when at least ``threshold`` of the item's distinct five-word shingles
(``docmill.llm.shingles``) occur in the document, however long the document is.

Items are partitioned by size.  Up to ``SMALL`` shingles, the sketch is the whole set and a candidate needs
``threshold`` of it; beyond, the sketch is the ``FUNCTIONS`` shingles that are minimal under as many hash functions and one
hit makes a candidate, as a true match misses all with probability (1 - threshold)^16 < 1e-11.  A long document is
never sketched: all its shingles probe the sketches, so its length costs no recall.  Candidates are verified against
the item's full set in the same task; only items that a document's shingles touch are counted.

Shingles that over ``HOT`` items of a block hold, such as a common opening, make no candidates of these.  An item with some is sketched by its
n - m + 1 rarest shingles instead, where n is its size and m what it needs: a match misses at most n - m, so it holds one of them.

With ``each_text``, as the query and the pipeline ask for, every text is an item of its own: null and repeated item_ids are searched text by
text, and an item of fewer than five words is one shingle of all its words that every window of as many words of a document meets.

Items come in blocks of at most ``BLOCK_ROWS`` shingles, the size bound of each broadcast; documents are scanned once a
block and never shuffled.

Defined results: null or empty texts and items without words match nothing; texts under five words are one shingle of
all their words; each input row is judged by itself, so repeated rows or doc_ids repeat; an item_id and text that repeat are
one item.  Without ``each_text``, an item_id that repeats is one item with the union of its texts' shingles, and a null one is no item; extra columns are ignored by ``hits`` and kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import written
from docmill.llm.shingles import WIDTH, hashed, mix

THRESHOLD = 0.8
SMALL = 8
FUNCTIONS = 16
#: A shingle that more items of a block hold isn't sketched where others tell the item.
HOT = 64
BLOCK_ROWS = 2_000_000
RESULT = "doc_id bigint, item_id bigint, n_shared bigint, n_item bigint, containment double"


def item_shingles(items: DataFrame, each_text: bool = False) -> DataFrame:
    """(key, item_id, width, shingle) rows, distinct; width is that of the document's windows that the shingle is looked up in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            widths = [WIDTH, *range(1, WIDTH)] if each_text else [WIDTH]
            for (i, n, bounds, h), *few in zip(*(hashed(b.column(2), w) for w in widths)):
                width, h = np.full(len(h), WIDTH, np.int32), h.copy()
                if few:
                    words = np.diff(few[0][2])
                    for r in np.flatnonzero((words > 0) & (words < WIDTH)):
                        _, _, at, own = few[words[r] - 1]
                        width[bounds[r]], h[bounds[r]] = words[r], own[at[r]]
                rows = pa.array(np.repeat(np.arange(i, i + n), np.diff(bounds)))
                yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(width), pa.array(h.view(np.int64))], ["key", "item_id", "width", "shingle"])

    picked = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    picked = picked.select(F.xxhash64(F.isnull("item_id"), "item_id", "text").alias("key"), "item_id", "text") if each_text else picked.where("item_id IS NOT NULL").select(F.col("item_id").alias("key"), "item_id", "text")
    return picked.mapInArrow(run, "key bigint, item_id bigint, width int, shingle bigint").distinct()


def _ranges(first: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each range."""
    return np.repeat(first - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())


class Index:
    """One block's sketches and full sets."""

    def __init__(self, rows: pa.Table, threshold: float):
        item, shingle, width = (rows[c].to_numpy() for c in ("key", "shingle", "width"))
        order = np.lexsort((shingle, item))
        item, shingle, width = item[order], shingle[order].view(np.uint64), width[order]
        self.keys, first, self.size = np.unique(item, return_index=True, return_counts=True)
        self.ids = rows["item_id"].combine_chunks().take(pa.array(order[first]))
        own = np.repeat(np.arange(len(self.keys)), self.size)
        #: width: (sorted shingles, their items) of items with so few words
        self.few = {}
        for w in np.unique(width[width < WIDTH]).tolist():
            at = np.flatnonzero(width == w)
            at = at[np.argsort(shingle[at], kind="stable")]
            self.few[w] = (shingle[at], own[at])
        long = width == WIDTH
        self.need = np.maximum(1, np.ceil(self.size * threshold - 1e-9).astype(np.int64))
        # How many of the block's items hold a shingle; hot ones don't sketch an item that others can tell.
        _, place, holders = np.unique(np.where(long, shingle, np.uint64(0)), return_inverse=True, return_counts=True)
        held = np.where(long, holders[place], 0)
        hot = np.bincount(own, held > HOT, len(self.keys)).astype(np.int64)
        keep = np.repeat((self.size <= SMALL) & (hot == 0), self.size)
        sketched = np.repeat(hot == 0, self.size)
        for f in range(FUNCTIONS):
            ranked = np.lexsort((mix(shingle + np.uint64(f * 0x9E3779B97F4A7C15 % (1 << 64))), own))
            keep[ranked[first]] = sketched[ranked[first]]
        ranked = np.lexsort((shingle, held, own))
        rank = np.empty(len(own), np.int64)
        rank[ranked] = np.arange(len(own)) - np.repeat(first, self.size)
        keep |= ~sketched & (rank <= np.repeat(self.size - self.need, self.size))
        keep &= long
        by = np.argsort(shingle[keep], kind="stable")
        self.sketch, self.sketch_item = shingle[keep][by], own[keep][by]
        #: item k holds ``full[start[k]:start[k] + size[k]]``, sorted
        self.full, self.start = shingle, first
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.sketch >> np.uint64(44)] = True
        self.least = np.where((self.size <= SMALL) & (hot == 0), self.need, 1)

    def _shared(self, k: np.ndarray, own: np.ndarray) -> np.ndarray:
        """How many shingles of each item ``k`` are among the sorted ``own``; items go in groups of a bounded number of shingles."""
        out, ends, i = np.empty(len(k), np.int64), np.cumsum(self.size[k]), 0
        while i < len(k):
            j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + BLOCK_ROWS, "right")))
            lens = self.size[k[i:j]]
            value = self.full[_ranges(self.start[k[i:j]], lens)]
            met = own[np.minimum(np.searchsorted(own, value), len(own) - 1)] == value
            out[i:j] = np.bincount(np.repeat(np.arange(j - i), lens), met, j - i)
            i = j
        return out

    def search(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, item position, shared shingles) of every verified pair."""
        rows, found, shared = [], [], []
        for w, (keys, items) in self.few.items():
            for i, _, bounds, h in hashed(texts, w):
                lo, hi = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
                at = np.flatnonzero(lo < hi)
                lo, lens = lo[at], (hi - lo)[at]
                k = items[_ranges(lo, lens)]
                r = np.repeat(np.searchsorted(bounds, at, "right") - 1, lens)
                pair = np.unique(r * len(self.keys) + k)
                rows += (i + pair // len(self.keys)).tolist()
                found += (pair % len(self.keys)).tolist()
                shared += [1] * len(pair)
        for i, _, bounds, h in hashed(texts) if len(self.sketch) else ():
            at = np.flatnonzero(self.maybe[h >> np.uint64(44)])
            at = at[self.sketch[np.minimum(np.searchsorted(self.sketch, h[at]), len(self.sketch) - 1)] == h[at]]
            for r in np.unique(np.searchsorted(bounds, at, "right") - 1):
                own = np.unique(h[bounds[r] : bounds[r + 1]])
                lo = np.searchsorted(self.sketch, own, "left")
                lens = np.searchsorted(self.sketch, own, "right") - lo
                k, n = np.unique(self.sketch_item[_ranges(lo, lens)], return_counts=True)
                k = k[n >= self.least[k]]
                n = self._shared(k, own)
                k, n = k[n >= self.need[k]], n[n >= self.need[k]]
                rows += [i + r] * len(k)
                found += k.tolist()
                shared += n.tolist()
        return np.array(rows, np.int64), np.array(found, np.int64), np.array(shared, np.int64)


def _indexes(items: DataFrame, threshold: float, each_text: bool) -> list:
    """Broadcast indexes, each of at most about BLOCK_ROWS rows."""
    spark = items.sparkSession
    rows = written(item_shingles(items, each_text), "items")
    blocks = -(-rows.count() // BLOCK_ROWS)
    out = []
    for k in range(blocks):
        t = rows.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == k).toArrow()
        if t.num_rows:
            out.append(spark.sparkContext.broadcast(Index(t, threshold)))
    return out


def hits(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, each_text: bool = False) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) of every contaminated document and item."""
    spark = docs.sparkSession
    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], RESULT)
    for index in _indexes(items, threshold, each_text):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            x = index.value
            for b in batches:
                rows, k, n = x.search(b.column(1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows)), x.ids.take(pa.array(k)), pa.array(n), pa.array(x.size[k].astype(np.int64)), pa.array(n / x.size[k])],
                    ["doc_id", "item_id", "n_shared", "n_item", "containment"],
                )

        out = out.union(picked.mapInArrow(run, RESULT))
    return out


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, each_text: bool = False) -> DataFrame:
    """``docs`` without the contaminated rows, all columns kept."""
    at = docs.columns.index("text")
    for index in _indexes(items, threshold, each_text):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for b in batches:
                bad = np.zeros(b.num_rows, bool)
                bad[index.value.search(b.column(at))[0]] = True
                yield b.filter(pa.array(~bad))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
