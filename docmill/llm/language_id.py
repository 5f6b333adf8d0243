"""Language identification by prediction by partial matching over bytes.

For each language the training texts give frozen statistics of byte contexts of order 0 to ``ORDER``.  Under escape method C
a byte seen n times after a context with N occurrences and D distinct successors costs -log2(n / (N + D)) bits; an unseen one
costs the escape, -log2(D / (N + D)), and is then coded one order lower, down to a uniform byte; a context never met
costs nothing to leave.  A text's code length is the exact sum over its bytes, each with the ``ORDER`` bytes before it (line feeds
before the text's start).  The language with the shortest code wins; ties go to the first name in order.  ``score`` is the
winner's posterior under equal priors, from the code lengths.

As the statistics are frozen, a byte's cost is a function of the last ORDER + 1 bytes, so the context trees are evaluated once
for every gram of the training texts and a text is scored by table lookups over its bytes; grams of no training text
fall through to the lower orders' tables.

Fitting uses a bounded sample: of each language the ``SAMPLE_ROWS`` different (doc_id, text) rows with the smallest hash of both, whatever their
length; a long text is counted in steps.  Statistics are sums over those rows.

``keep`` also rejects what the model tells: a text whose shortest code is over ``MARGIN`` bits longer than the text itself (8 bits a byte), so
that no learned language describes it, as one in a script that was never learnt.

Defined results: a null text, or one without a letter, is ``und`` with score 0; without any training row all texts are
``und``; a null doc_id is not held out and not learnt from; rows repeat as they come; extra columns are ignored by
``identify`` and kept by ``keep``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmill.llm.common import steps, utf8

ORDER = 3
SAMPLE_ROWS = 1000
MARGIN = 64
UNDETERMINED = "und"
_LATIN = re.compile("[A-Za-z]")


def grams(at: np.ndarray, data: np.ndarray) -> np.ndarray:
    """uint32 key of each byte with the three before it, line feeds before each text's start."""
    x = data.astype(np.uint32)
    key = x.copy()
    for d in (1, 2, 3):
        shifted = np.empty_like(x)
        shifted[d:] = x[: len(x) - d]
        shifted[:d] = 10
        for e in range(d):  # the d-th byte before a text's e-th byte lies outside the text for e < d
            p = at[:-1] + e
            shifted[p[p < at[1:]]] = 10
        key |= shifted << np.uint32(8 * d)
    return key


def pieces(at: np.ndarray, data: np.ndarray, i: int, j: int, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
    """(row, grams) of the texts i..j-1, those of a text of over ``most`` bytes in several parts."""
    if j - i == 1:
        for lo in range(int(at[i]), int(at[j]), most):
            before = max(int(at[i]), lo - ORDER)
            hi = min(lo + most, int(at[j]))
            yield i, grams(np.array([0, hi - before]), data[before:hi])[lo - before :]
        return
    key = grams(at[i : j + 1] - at[i], data[at[i] : at[j]])
    for r in range(i, j):
        yield r, key[at[r] - at[i] : at[r + 1] - at[i]]


def counted(lang: str, key: np.ndarray) -> pa.RecordBatch:
    g, n = np.unique(key, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(g)), pa.array(g.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])


def _count(rows: DataFrame) -> DataFrame:
    """(lang, gram, n) over (lang, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, data = utf8(b.column(1))
            langs = b.column(0).to_pylist()
            for i, j in steps(at):
                by: dict[str, list[np.ndarray]] = {}
                for r, key in pieces(at, data, i, j):
                    by.setdefault(langs[r], []).append(key)
                    if j - i == 1:  # a long text: its parts one by one
                        yield counted(langs[r], key)
                if j - i > 1:
                    for lang, keys in by.items():
                        yield counted(lang, np.concatenate(keys))

    return rows.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def lettered(text: str | None) -> bool:
    return bool(text) and (_LATIN.search(text) is not None or any(map(str.isalpha, text)))


class Model:
    """Cost tables of the languages' context trees."""

    def __init__(self, lang: list[str], gram: np.ndarray, n: np.ndarray):
        self.langs = sorted(set(lang))
        which = np.array([self.langs.index(x) for x in lang], np.int64) if lang else np.zeros(0, np.int64)
        L = len(self.langs)
        union = np.unique(gram).astype(np.uint32)
        tri = np.unique(union & 0xFFFFFF).astype(np.uint32)
        context = np.unique(union >> 8).astype(np.uint32)
        self.c1 = np.empty((256, L), np.float32)
        self.c2 = np.empty((65536, L), np.float32)
        self.c3, self.tri = np.empty((len(tri), L), np.float32), tri
        self.e2 = np.zeros((65536, L), np.float32)
        self.e3, self.context = np.zeros((len(context), L), np.float32), context
        self.c4 = np.empty((len(union), L), np.float32)
        for k in range(L):
            g, c = gram[which == k].astype(np.uint32), n[which == k].astype(np.float64)

            def level(keys: np.ndarray, lower: np.ndarray, bits: int) -> tuple[np.ndarray, dict]:
                """Cost of each key (successor in the low byte) over ``lower``, and escape costs by context."""
                own, place = np.unique(g & np.uint32((1 << bits) - 1), return_inverse=True)
                count = np.bincount(place, c)
                ctx, place = np.unique(own >> 8, return_inverse=True)
                total, distinct = np.bincount(place, count), np.bincount(place)
                at = np.searchsorted(ctx, keys >> 8)
                at[at == len(ctx)] = 0
                met = ctx[at] == keys >> 8
                escape = np.where(met, -np.log2(distinct[at] / (total[at] + distinct[at])), 0.0)
                own_at = np.searchsorted(own, keys)
                own_at[own_at == len(own)] = 0
                seen = own[own_at] == keys
                return np.where(seen, -np.log2(np.where(seen, count[own_at], 1) / (total[at] + distinct[at])), escape + lower), dict(ctx=ctx, esc=-np.log2(distinct / (total + distinct)))

            self.c1[:, k], _ = level(np.arange(256, dtype=np.uint32), np.full(256, 8.0), 8)
            two = np.arange(65536, dtype=np.uint32)
            self.c2[:, k], _ = level(two, self.c1[two & 255, k], 16)
            self.c3[:, k], x = level(tri, self.c2[tri & 65535, k], 24)
            self.e2[x["ctx"], k] = x["esc"]
            self.c4[:, k], x = level(union, self.c3[np.searchsorted(tri, union & 0xFFFFFF), k], 32)
            self.e3[np.searchsorted(context, x["ctx"]), k] = x["esc"]
        # Open addressing over the grams; a slot's row is one past the gram's, 0 where empty.
        self.shift = np.uint32(32 - max(8, int(np.ceil(np.log2(max(len(union), 1) * 4)))))
        self.keys, self.rows = np.zeros(1 << (32 - int(self.shift)), np.uint32), np.zeros(1 << (32 - int(self.shift)), np.int32)
        todo = np.arange(len(union))
        slot = self._slot(union)
        while len(todo):
            free = self.rows[slot[todo]] == 0
            _, one = np.unique(slot[todo][free], return_index=True)
            put = todo[free][one]
            self.keys[slot[put]], self.rows[slot[put]] = union[put], put + 1
            left = np.ones(len(union), bool)
            left[put] = False
            todo = todo[left[todo]]
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint32(2654435769)) >> self.shift).astype(np.int64)

    def costs(self, key: np.ndarray) -> np.ndarray:
        """Bits of each gram's last byte, by language."""
        slot = self._slot(key)
        row = self.rows[slot]
        again = np.flatnonzero((row != 0) & (self.keys[slot] != key))
        while len(again):
            slot[again] = (slot[again] + 1) & (len(self.keys) - 1)
            row[again] = self.rows[slot[again]]
            again = again[(row[again] != 0) & (self.keys[slot[again]] != key[again])]
        out = self.c4[row - 1]
        new = np.flatnonzero(row == 0)
        if len(new):
            k = key[new]
            low = self.c2[k & 0xFFFF] + self.e2[(k >> 8) & 0xFFFF]
            at = np.minimum(np.searchsorted(self.tri, k & 0xFFFFFF), len(self.tri) - 1)
            low = np.where((self.tri[at] == k & 0xFFFFFF)[:, None], self.c3[at], low)
            at = np.minimum(np.searchsorted(self.context, k >> 8), len(self.context) - 1)
            out[new] = low + np.where((self.context[at] == k >> 8)[:, None], self.e3[at], np.float32(0))
        return out

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, bits a byte) of each text."""
        n = len(texts)
        langs, score, rate = [UNDETERMINED] * n, np.zeros(n), np.zeros(n)
        if not self.langs:
            return langs, score, rate
        at, data = utf8(texts)
        for i, j in steps(at, 1 << 18):
            lens = np.diff(at[i : j + 1])
            if not lens.sum():
                continue
            bits = np.zeros((j - i, len(self.langs)))
            full = np.flatnonzero(lens)
            if j - i == 1:
                for _, key in pieces(at, data, i, j):
                    bits[0] += self.costs(key).sum(axis=0, dtype=np.float64)
            else:
                bits[full] = np.add.reduceat(self.costs(grams(at[i : j + 1] - at[i], data[at[i] : at[j]])), (at[i:j] - at[i])[full], axis=0, dtype=np.float64)
            best = bits.argmin(axis=1)
            least = bits.min(axis=1, keepdims=True)
            posterior = 1 / np.exp2(np.maximum(least - bits, -1000)).sum(axis=1)
            for r in full:
                text = texts[i + int(r)].as_py()
                if lettered(text):
                    langs[i + r], score[i + r], rate[i + r] = self.langs[best[r]], posterior[r], least[r, 0] / lens[r]
        return langs, score, rate


def held_out(column: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(labelled: DataFrame) -> Model:
    """Model of (doc_id, text, lang) rows; null ids, texts and languages aside."""
    rows = labelled.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull()).withColumn("key", F.xxhash64("doc_id", "text"))
    # A language's share of rows with small hashes, three times what is asked for, so the ranking below never
    # gathers a language; a hash rank within that share is the rank among all rows.  Equal rows count once, before and after the shuffle.
    spread = (F.col("key").cast("double") + 2.0**63) / 2.0**64
    sizes = F.broadcast(rows.groupBy("lang").agg(F.approx_count_distinct("key", 0.02).alias("size")))  # one row a language
    few = rows.join(sizes, "lang").where(spread <= 3.0 * SAMPLE_ROWS / F.col("size")).groupBy("lang", "key").agg(F.first("text").alias("text"))
    order = Window.partitionBy("lang").orderBy("key")
    sample = few.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SAMPLE_ROWS).select("lang", "text")
    got = _count(sample).toArrow()
    return Model(got["lang"].to_pylist(), got["gram"].to_numpy(), got["n"].to_numpy())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, bits_per_byte) of each row, from its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, score, rate = shared.value.predict(b.column(2))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(langs, pa.string()), pa.array(score), pa.array(rate)], ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"])

    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double, bits_per_byte double")


def keep(docs: DataFrame, model: Model, column: str | None = None, margin: float = MARGIN) -> DataFrame:
    """``docs`` without the rows of undetermined language and those that no learned language describes (see the module's text; with a
    model that learnt nothing: without those that have no letter); ``column`` then names a column that gets the prediction."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    schema = docs.schema if column is None else T.StructType([*docs.drop(column).schema.fields, T.StructField(column, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = b.column(at).cast(pa.string())
            langs, _, rate = m.predict(texts)
            size = np.diff(utf8(texts)[0])
            # A model that learnt nothing rejects nothing that could be told.
            stay = (np.array(langs) != UNDETERMINED) & ((rate - 8) * size <= margin) if m.langs else np.array([lettered(t) for t in texts.to_pylist()], bool)
            if column is not None:
                names = [n for n in b.schema.names if n != column]
                b = pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(langs, pa.string())], [*names, column])
            yield b.filter(pa.array(stay))

    return docs.mapInArrow(run, schema)
