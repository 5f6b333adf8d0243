"""Main text of web pages by a recurrent block labeller.

A page is read as a sequence of leaf blocks (``html_leaves``); a bidirectional LSTM (``block_lstm``) reads each leaf's tag path, hashed words and a few
numbers, and labels every leaf in the context of the whole page.  The text is the leaves labelled as main, in page order.

The network is trained on ``EXAMPLES`` pages laid out by rule from a fixed seed, whose parts are known, and on up to ``SAMPLE`` pages of the table
itself, of at most ``SAMPLE_CHARS`` characters, that say where their article is (``article`` or ``main``): a bounded sample, and of a longer page ``STEPS`` leaves from
its beginning.  The examples' words are those of the sample.  Every page is then labelled whole.

Pages are labelled in tasks, where they are; the model is broadcast and has a fixed size.  A task holds one group of pages of
about ``GROUP_CHARS`` characters, or one page.

Defined results: one row for each input row: page_id, url, text, n_chars.  A null or empty page, or one without main text, has the empty
text; what isn't HTML is one block, labelled like any other; rows that repeat are rows of their own with equal texts; a null page_id or url stays
null; extra columns are ignored, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm import block_lstm
from docmill.llm.html_leaves import Examples, Leaf, features, leaves

EXAMPLES = 1500
SAMPLE = 200
SAMPLE_CHARS = 1 << 16
STEPS = 96
BATCH = 24
ROUNDS = 8
GROUP_CHARS = 1 << 20
RESULT = "page_id bigint, url string, text string, n_chars bigint"


def _sample(pages: DataFrame) -> list[str]:
    """About SAMPLE different pages by their hash; each task keeps one of each before the shuffle."""
    short = pages.select(F.col("html").cast("string").alias("html")).where(F.length("html").between(1, SAMPLE_CHARS)).withColumn("key", F.xxhash64("html"))
    parts = max(1, short.agg(F.approx_count_distinct("key", 0.02)).first()[0] // SAMPLE)
    picked = short.where(F.pmod("key", F.lit(parts)) == 0).groupBy("key").agg(F.first("html").alias("html")).orderBy("key").limit(2 * SAMPLE)
    return [r.html for r in picked.select("html").toLocalIterator()]


def _batches(pages: list[list[Leaf]]) -> list[tuple]:
    """Pages of like lengths together."""
    order = sorted((p[:STEPS] for p in pages if p), key=len)
    groups = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
    return [(features(g), np.array([-1 if x.label is None else x.label for p in g for x in p])) for g in groups]


def train(pages: DataFrame) -> dict[str, np.ndarray]:
    """The network's weights."""
    sample = [leaves(html) for html in _sample(pages)]
    words = sorted({w for page in sample for x in page for w in x.text.split() if len(w) < 40})
    known = []
    for page in sample:
        if any(x.label == 1 for x in page):  # what lies outside the article of such a page is known, too
            for x in page:
                x.label = x.label or 0
            known.append(page)
    made = Examples(words[:: max(1, len(words) // 5000)])
    return block_lstm.fit(_batches([leaves(made.page()) for _ in range(EXAMPLES)] + known), ROUNDS)


def labelled(model: dict[str, np.ndarray], pages: list[str]) -> list[list[tuple[str, bool]]]:
    """(text, whether it is main) of the leaves of each page."""
    read = [leaves(p) for p in pages]
    if not any(read):
        return [[] for _ in read]
    return [[(x.text, bool(s > 0)) for x, s in zip(page, odds)] for page, odds in zip(read, block_lstm.scores(model, features(read)))]


def extract(pages: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """(page_id, url, text, n_chars) of each page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def texts(html: list[str | None]) -> Iterator[str]:
        group: list[str] = []
        for k, page in enumerate(html):
            group.append(page or "")
            if k == len(html) - 1 or sum(map(len, group)) + len(html[k + 1] or "") > GROUP_CHARS:
                for page_leaves in labelled(shared.value, group):
                    yield "\n\n".join(text for text, main in page_leaves if main)
                group = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                made = list(texts(part.column(2).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(made, pa.string()), pa.array([len(t) for t in made], pa.int64())], ["page_id", "url", "text", "n_chars"])

    picked = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return picked.mapInArrow(run, RESULT)
