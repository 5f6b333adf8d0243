"""Toxicity severity by cumulative-link ordinal regression.

P(grade > k) = sigmoid(w . x - t_k), with one weight vector for all thresholds t_0 < t_1 < ...; the expected severity is the sum of
these probabilities.  Features are hashed words and ``GRAM``-byte grams of the lower-cased text with 1 + log(count) values; those with
an association with the label of ``EVIDENCE`` (G squared) in the sample, and ``LEAST`` documents of it, get weights, at most the ``FEATURES`` with the
strongest.

Labels are 0 or 1; a first fit with one threshold ranks the toxic documents of the sample, whose upper half by that
score gets grade 2, and the ordinal fit learns all three grades.  Labels that are graded already (a maximum over 1) are used as
they are.

Fitting uses a bounded sample: of each label the documents whose hash of doc_id is in a share of about ``SAMPLE`` of them, and of a doc_id that several rows
have the text with the least hash.  Features are counted and chosen in Spark; about SAMPLE x FEATURES values a label, four bytes each, go to
the driver at most, whatever the texts' lengths.  Weights are a table of 2^``BITS`` floats, so what is broadcast doesn't grow.

Defined results: a null text, or one without words, has no features and gets the intercepts' severity; rows repeat as
they come; labels without a document or with null columns aren't learnt from; a doc_id that repeats in labels counts
with its highest label; without labels of two kinds every severity is 0; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import steps, utf8, written
from docmill.llm.shingles import _words, mix

BITS = 20
SAMPLE = 3000
GRAM = 6
LEAST = 5
EVIDENCE = 12.0
FEATURES = 1 << 13
ROUNDS, RATE, DECAY = 300, 0.1, 1e-5


def sparse(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, bounds, features, values) by step: row r has ``features[bounds[r]:bounds[r+1]]``, distinct."""
    at, data = utf8(pc.utf8_lower(texts.fill_null("")))
    for i, j in steps(at, 1 << 19):
        own, cut = data[at[i] : at[j]], at[i : j + 1] - at[i]
        words, k = _words(own, cut)
        rows = np.repeat(np.arange(j - i, dtype=np.uint64), np.diff(k))
        wide = own.astype(np.uint64)
        gram = np.zeros(max(len(own) - GRAM + 1, 0), np.uint64)
        for d in range(GRAM):
            gram = (gram << np.uint64(8)) | wide[d : d + len(gram)]
        inside = np.repeat(np.arange(j - i, dtype=np.uint64), np.diff(cut))
        ok = inside[: len(gram)] == inside[GRAM - 1 :] if len(gram) else np.zeros(0, bool)
        hashes = np.concatenate([words, mix(gram[ok] + np.uint64(1))]) >> np.uint64(64 - BITS)
        key, n = np.unique((np.concatenate([rows, inside[: len(gram)][ok]]) << np.uint64(BITS)) | hashes, return_counts=True)
        bounds = np.searchsorted(key, np.arange(j - i + 1, dtype=np.uint64) << np.uint64(BITS))
        yield i, j - i, bounds, (key & np.uint64((1 << BITS) - 1)).astype(np.int64), 1 + np.log(n)


def _rows_dot(bounds: np.ndarray, features: np.ndarray, values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return np.bincount(rows, values * weights[features], len(bounds) - 1)


def evidence(n1: Column, n0: Column, N1: int, N0: int) -> Column:
    """Log-likelihood ratio (G squared) of a feature's presence against the label."""
    total = F.lit(0.0)
    for x, n in ((n1, N1), (n0, N0)):
        for y, both in ((x, n1 + n0), (n - x, N1 + N0 - n1 - n0)):
            expected = both * (n / (N1 + N0))
            total = total + F.when(y > 0, 2 * y * F.log(y / expected)).otherwise(0.0)
    return total


class Model:
    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def above(self, dot: np.ndarray) -> np.ndarray:
        """P(grade > k) by row and k."""
        return 1 / (1 + np.exp(-(dot[:, None] - self.thresholds[None, :])))


def fit(bounds: np.ndarray, features: np.ndarray, values: np.ndarray, grade: np.ndarray) -> Model:
    """Maximum likelihood by Adam over all rows of the sample, which hold selected features only."""
    n, K = len(bounds) - 1, int(grade.max())
    rows = np.repeat(np.arange(n), np.diff(bounds))
    own, features = np.unique(features, return_inverse=True)  # columns that are used
    x = values
    w, first, gaps = np.zeros(len(own)), 0.0, np.zeros(K - 1)
    moments = [[np.zeros(len(own)), np.zeros(len(own))], [np.zeros(K), np.zeros(K)]]
    for step in range(1, ROUNDS + 1):
        t = first + np.concatenate(([0.0], np.cumsum(np.exp(gaps))))
        eta = np.bincount(rows, x * w[features], n)
        edge = 1 / (1 + np.exp(-(eta[:, None] - t[None, :])))  # P(grade > k)
        up = np.hstack([np.ones((n, 1)), edge])
        down = np.hstack([edge, np.zeros((n, 1))])
        r = np.arange(n)
        p = np.maximum(up[r, grade] - down[r, grade], 1e-9)
        slope = edge * (1 - edge)
        lower, upper = np.hstack([np.zeros((n, 1)), slope])[r, grade], np.hstack([slope, np.zeros((n, 1))])[r, grade]
        g_eta = -(lower - upper) / p / n
        gt = np.zeros(K)
        np.add.at(gt, grade[grade > 0] - 1, (lower / p / n)[grade > 0])
        np.add.at(gt, grade[grade < K], -(upper / p / n)[grade < K])
        g_first = gt.sum()
        g_gaps = np.array([gt[k + 1 :].sum() * np.exp(gaps[k]) for k in range(K - 1)])
        for which, g in ((0, np.bincount(features, x * g_eta[rows], len(own)) + DECAY * w), (1, np.concatenate(([g_first], g_gaps)))):
            m, s = moments[which]
            m[:] = 0.9 * m + 0.1 * g
            s[:] = 0.99 * s + 0.01 * g * g
            move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-9)
            if which == 0:
                w -= move
            else:
                first -= move[0]
                gaps -= 0.2 * move[1:]
    weights = np.zeros(1 << BITS, np.float32)
    weights[own] = w
    return Model(weights, first + np.concatenate(([0.0], np.cumsum(np.exp(gaps)))))


def train(docs: DataFrame, labels: DataFrame, column: str = "toxic") -> Model | None:
    """Fit on a bounded sample of the labelled documents."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull()).groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("grade"))
    sizes = {r["grade"]: r["n"] for r in known.groupBy("grade").agg(F.count("*").alias("n")).collect()}  # one row a grade
    if len(sizes) < 2:
        return None
    lowest = min(sizes)
    # By a threshold of the hash, so nothing is ranked.
    spread = (F.xxhash64("doc_id").cast("double") + 2.0**63) / 2.0**64
    share = F.coalesce(*[F.when(F.col("grade") == g, F.lit(SAMPLE / n)) for g, n in sizes.items()])
    sample = known.where(spread <= share).select("doc_id", "grade")
    # About SAMPLE rows a grade: a proven bound, so documents are filtered where they lie.
    met = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL").join(F.broadcast(sample), "doc_id")
    picked = written(met.groupBy("doc_id", "grade").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("grade", "text"), "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            grade = b.column(0).to_numpy()
            for i, n, bounds, features, _ in sparse(b.column(1)):
                toxic = np.repeat(grade[i : i + n] > lowest, np.diff(bounds))
                f, place = np.unique(features, return_inverse=True)
                n1 = np.bincount(place, toxic, len(f)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(f), pa.array(n1), pa.array(np.bincount(place, minlength=len(f)) - n1)], ["feature", "n1", "n0"])

    there = {r["grade"]: r["n"] for r in picked.groupBy("grade").agg(F.count("*").alias("n")).collect()}  # one row a grade
    N1, N0 = (sum(n for g, n in there.items() if (g > lowest) == toxic) for toxic in (True, False))
    if not N1 or not N0:
        return None
    counts = picked.mapInArrow(count, "feature bigint, n1 bigint, n0 bigint").groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).where(F.col("n1") + F.col("n0") >= LEAST)
    best = counts.select("feature", evidence(F.col("n1"), F.col("n0"), N1, N0).alias("evidence")).where(F.col("evidence") >= EVIDENCE).orderBy(F.desc("evidence"), "feature").limit(FEATURES)
    chosen = np.zeros(1 << BITS, bool)
    chosen[best.select("feature").toArrow()["feature"].to_numpy()] = True
    selected = docs.sparkSession.sparkContext.broadcast(np.packbits(chosen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = np.unpackbits(selected.value).astype(bool)
        for b in batches:
            for i, n, bounds, features, values in sparse(b.column(1)):
                keep = use[features]
                cut = pa.array(np.concatenate(([0], np.cumsum(keep)))[bounds].astype(np.int32))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, n), pa.ListArray.from_arrays(cut, pa.array(features[keep], pa.int32())), pa.ListArray.from_arrays(cut, pa.array(values[keep], pa.float32()))], ["grade", "features", "values"])

    got = picked.mapInArrow(run, "grade int, features array<int>, values array<float>").toArrow().combine_chunks()
    grade = got["grade"].to_numpy()
    if len(set(grade.tolist())) < 2:
        return None
    lens = np.array(pc.list_value_length(got["features"]))
    features, values = (np.array(pc.list_flatten(got[c])).astype(kind) for c, kind in (("features", np.int64), ("values", np.float64)))
    bounds = np.concatenate(([0], np.cumsum(lens)))
    grade = grade - grade.min()
    clean, sampled = int((grade == 0).sum()), len(grade)
    # The sample is balanced: thresholds move by the log ratio of the odds in the labels to those in the sample.
    shift = np.log((sum(sizes.values()) - sizes[lowest]) / sizes[lowest]) - np.log((sampled - clean) / clean)
    if grade.max() == 1:
        model = fit(bounds, features, values, grade)
        dot = _rows_dot(bounds, features, values, model.weights)
        grade = np.where((grade == 1) & (dot > np.median(dot[grade == 1])), 2, grade)
    model = fit(bounds, features, values, grade)
    return Model(model.weights, model.thresholds - shift)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, severity, grade, toxic, p_toxic) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for i, n, bounds, features, values in sparse(b.column(1)):
                above = np.zeros((n, 1)) if m is None else m.above(_rows_dot(bounds, features, values, m.weights))
                share = np.hstack([np.ones((n, 1)), above]) - np.hstack([above, np.zeros((n, 1))])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, n), pa.array(above.sum(axis=1)), pa.array(share.argmax(axis=1).astype(np.int32)), pa.array(above[:, 0] >= 0.5), pa.array(above[:, 0].copy())],
                    ["doc_id", "severity", "grade", "toxic", "p_toxic"],
                )

    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id bigint, severity double, grade int, toxic boolean, p_toxic double")
