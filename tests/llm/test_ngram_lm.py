import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docmill.llm import elias_fano as E
from docmill.llm import ngram_lm as L


def test_elias_fano_finds_and_reads():
    rng = np.random.default_rng(1)
    for top, n in ((50, 20), (10**9, 500), (10**12, 20_000), (5, 5), (3, 3000), (1 << 62, 10_000), (10**7, 3)):
        values = np.sort(rng.integers(0, top, n).astype(np.uint64))
        ef = E.EliasFano(*E.EliasFano.encode(values).values())
        assert (ef.at(np.arange(n)) == values).all()
        own = np.unique(values)
        assert (ef.find(own) == np.searchsorted(values, own)).all()
        absent = np.setdiff1d(rng.integers(0, top * 2, 500).astype(np.uint64), values)
        assert (ef.find(absent) == -1).all()
        least = np.searchsorted(values, own) + 1  # the range begins after the value
        assert (ef.find(own, least, np.full(len(own), n)) == np.where(np.searchsorted(values, own, "right") > least, least, -1)).all()
    assert (E.EliasFano(*E.EliasFano.encode(np.zeros(0, np.uint64)).values()).find(np.array([0, 7], np.uint64)) == -1).all()


def test_values_are_quantised():
    few, many = np.array([0.5, 0.25, 0.5, 0.125]), np.random.default_rng(2).random(100_000)
    code, bins = E.quantised(few)
    assert (bins[code] == few).all()
    code, bins = E.quantised(many)
    assert code.dtype == np.uint8 and np.abs(bins[code] - many).max() < 0.01


def test_files_are_mapped(tmp_path):
    E.save({"a": np.arange(5), "b": np.array([1.5])}, str(tmp_path / "x"))
    got = E.load(str(tmp_path / "x"))
    assert got["a"].tolist() == [0, 1, 2, 3, 4] and got["b"].tolist() == [1.5] and not got["a"].flags.owndata


def test_keys_pack_and_unpack():
    rng = np.random.default_rng(3)
    for n in (1, 1000):
        key = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for most in (5, 1 << 40):
            count = rng.integers(1, most, len(key))
            back = L.unpacked_keys(L.packed_keys(key, count), len(key))
            assert (back[0] == key).all() and (back[1] == count).all()


END = b"\n"  # no word holds a line feed


def test_tokens_by_digest(monkeypatch):
    texts = ["The the  THE\tcat", None, "", "a\u00a0b É é", "x\x0by\x0cz\rw\n", " lead and trail ", "word " * 50]
    monkeypatch.setattr(L, "PART", 32)  # so that long texts are hashed in parts
    monkeypatch.setattr(L, "steps", lambda at, most: ((i, i + 1) for i in range(len(at) - 1)))
    seen = {}
    for i, n, bounds, h, check in L.digests(pa.array(texts)):
        for r in range(n):
            own = list(zip(h[bounds[r] : bounds[r + 1]].tolist(), check[bounds[r] : bounds[r + 1]].tolist()))
            want = [*(texts[i + r] or "").encode().lower().split(), END]
            assert len(own) == len(want)
            assert all(seen.setdefault(w, d) == d for w, d in zip(want, own))
    assert len(set(seen.values())) == len(seen)


def base(rows):
    tokens = {i: (r.text or "").encode().lower().split() + [END] for i, r in enumerate(rows)}
    held = {i: r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for i, r in enumerate(rows)}
    c = Counter(t for i in tokens if not held[i] for t in tokens[i])
    N, V = sum(c.values()), len(c)
    return sorted((str(r.doc_id), held[i], len(tokens[i]), sum(c[t] > 0 for t in tokens[i]), N, round(sum(math.log10((c[t] + 1) / (N + V + 1)) for t in tokens[i]), 5)) for i, r in enumerate(rows))


def got(rows):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows)


def dictionary_scores(rows, order=3):
    """{row: log10 probability} by plain dictionaries: interpolated absolute discounting over n-grams that occur twice or more."""
    tokens = [[*(r.text or "").encode().lower().split(), END] for r in rows]
    train = [t for r, t in zip(rows, tokens) if not (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2)]
    counts = [Counter(tuple(t[i : i + k]) for t in train for i in range(len(t) - k + 1)) for k in range(1, order + 1)]
    kept = [counts[0]]
    for k in range(1, order):
        kept.append({g: n for g, n in counts[k].items() if n >= L.LEAST and (k == 1 or g[:-1] in kept[k - 1]) and all(counts[0][(w,)] > 1 for w in g)})
    mass = [Counter() for _ in range(order)]
    for k in range(1, order):
        for g, n in kept[k].items():
            mass[k][g[:-1]] += (n - L.DISCOUNT) / counts[k - 1][g[:-1]]
    N, V = sum(counts[0].values()), len(counts[0])
    out = []
    for t in tokens:
        total = 0.0
        for i, w in enumerate(t):
            p = (counts[0][(w,)] + 1) / (N + V + 1)
            for k in range(1, min(i, order - 1) + 1):
                h = tuple(t[i - k : i])
                if k > 1 and h not in kept[k - 1]:
                    break
                p = ((kept[k][(*h, w)] - L.DISCOUNT) / counts[k - 1][h] if (*h, w) in kept[k] else 0.0) + (1 - mass[k][h]) * p
            total += math.log10(p)
        out.append(total)
    return out


@pytest.mark.parametrize("limits", [(L.SHARD, L.TYPES, L.HELD), (3000, 500, 2000)])
def test_scores_equal_counting(spark, documents, monkeypatch, limits):
    for name, x in zip(("SHARD", "TYPES", "HELD"), limits):
        monkeypatch.setattr(L, name, x)
    found = L.model_scores(documents).collect()
    rows = documents.collect()
    for a, b in zip(got(found), base(rows)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-6)
    want = dict(zip([r.doc_id for r in rows], dictionary_scores(rows)))
    error = [abs(r.score - want[r.doc_id]) / abs(want[r.doc_id]) for r in found]
    assert max(error) < 0.05 and np.mean(error) < 0.002  # probabilities are quantised


def test_scores_equal_a_dictionary_model(spark, monkeypatch):
    monkeypatch.setattr(L, "SHARD", 40)  # the most frequent tokens' contexts are cut
    texts = ["a b c a b d a b c"] * 6 + ["b c b c a the end"] * 5 + [f"a x{i} b y{i} a z{i}" for i in range(30)] + ["a c d", "x1 a x2 a x1 a x2", "q", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = docs.collect()
    found = {r.doc_id: r.score for r in L.model_scores(docs).collect()}
    assert [found[r.doc_id] for r in rows] == pytest.approx(dictionary_scores(rows), rel=1e-9)


def test_probabilities_sum_to_one(spark, tmp_path):
    docs = spark.createDataFrame([(i, "a b c a b d a b c") for i in range(10)] + [(20 + i, "b c b c a") for i in range(10)], "doc_id bigint, text string")
    rows, model = L.train(docs, F.lit(False), str(tmp_path))
    ids = {w: int(np.frombuffer(r.ids, "<u4")[i]) for r in rows.collect() for i, w in enumerate(r.ids and ["a b c a b d a b c", "b c b c a"][r.n_tokens == 6].split())}
    assert len(set(ids.values())) == 4 and model.V == 5
    counts = L.occurrences_of(model.levels[0], np.arange(model.V))
    for context in ("a", "b", "a b", "b c", "d a", "c c"):
        total = 0.0
        for w in [*range(model.V), L.UNSEEN]:
            seq = np.array([*(ids[x] for x in context.split()), w])
            plain = np.array([(counts[x] + 1 if x < model.V else 1) / (model.N + model.V + 1) for x in seq])
            total += model.score(seq, np.array([0, len(seq)]), plain)[-1]
        assert total == pytest.approx(1, abs=1e-9), context


def test_context_helps_on_regular_text(spark):
    docs = spark.createDataFrame([(i, " ".join("%s goes to the %s and back ." % (a, b) for a, b in (("anna", "lake"), ("bob", "city"), ("carl", "farm")) * (1 + i % 3))) for i in range(60)], "doc_id bigint, text string")
    fresh = [r for r in L.model_scores(docs).collect() if r.held_out]
    assert fresh and sum(r.score for r in fresh) > 0.5 * sum(r.base_score for r in fresh)


def test_edges(spark, edges, nothing):
    rows = L.model_scores(edges).collect()
    for a, b in zip(got(rows), base(edges.collect())):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-3)
    assert L.model_scores(nothing).count() == 0
