import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from docmill.llm import chosen_path
from docmill.llm.components import components


def shingles(text):
    """Sets of five words by a way of their own: ASCII letters, digits, underscores and all beyond ASCII make words."""
    words = re.findall("[a-z0-9_\x80-\U0010ffff]+", text.lower())
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows, threshold=0.8):
    """{doc_id: (class_id, n_links)} of (doc_id, text) rows with distinct ids."""
    texts = list(dict.fromkeys(t or "" for _, t in rows))
    sets = [shingles(t) for t in texts]
    holders, links, root = defaultdict(list), defaultdict(set), list(range(len(texts)))
    for i, s in enumerate(sets):
        met = Counter(j for x in s for j in holders[x])
        for j, n in met.items():
            if n >= threshold * (len(s) + len(sets[j]) - n) - 1e-9:
                links[i].add(j)
                links[j].add(i)
        for x in s:
            holders[x].append(i)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in links:
        for j in links[i]:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    place, least = {t: i for i, t in enumerate(texts)}, {}
    for d, t in rows:
        least[find(place[t or ""])] = min(least.get(find(place[t or ""]), 1 << 60), d)
    return {d: (least[find(place[t or ""])], len(links[place[t or ""]])) for d, t in rows}


def planted():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    rows, k = [], 0
    for group in range(40):  # near copies around the threshold
        base = [rng.choice(words) for _ in range(rng.randint(6, 120))]
        for _ in range(rng.randint(1, 5)):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 60))):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((k := k + 1, " ".join(own)))
    base = [rng.choice(words) for _ in range(150)]  # one large group, with exact copies
    for i in range(150):
        own = list(base)
        own[rng.randrange(150)] = f"x{i}"
        rows.append((k := k + 1, " ".join(own)))
        if i % 3 == 0:
            rows.append((k := k + 1, " ".join(own)))
    shared = " ".join(rng.choice(words) for _ in range(60))  # a passage that unrelated texts share
    for _ in range(100):
        rows.append((k := k + 1, shared + " " + " ".join(rng.choice(words) for _ in range(60))))
    return rows


@pytest.mark.parametrize("limits", [(128, 1024, 512), (8, 40, 30)])
def test_links_and_classes_equal_brute_force(spark, limits, monkeypatch):
    for name, value in zip(("SMALL", "BLOCK", "VERIFY_BLOCK"), limits):
        monkeypatch.setattr(chosen_path, name, value)
    rows = planted()
    got = {r.doc_id: (r.class_id, r.n_links) for r in chosen_path.join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == brute(rows)


def test_edges(spark, edges, nothing):
    rows = chosen_path.join(edges).collect()
    assert len(rows) == edges.count()
    seven = [(r.class_id, r.n_links, r.n_copies) for r in rows if r.doc_id in (7, 8)]
    assert seven == [(7, 0, 2)] * 3
    assert {(r.class_id, r.n_copies) for r in rows if r.doc_id in (1, 2)} == {(1, 1)}
    kept = chosen_path.keep_one(edges)
    assert kept.columns == edges.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 7, 10, 11, 12]
    assert chosen_path.join(nothing).count() == 0 and chosen_path.keep_one(nothing).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {i: 1 for i in range(1, 31)} | {i: 100 for i in range(100, 140)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_classes_that_share_a_doc_id_all_stay(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(12)) for c in "xyz")
    rows = [(9, one), (9, two), (9, one), (10, two), (11, three), (None, three)]
    kept = chosen_path.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(map(tuple, kept)) == [(9, one), (9, two), (11, three)]


def test_runs_reach_their_recall():
    n = chosen_path.runs()
    assert chosen_path.met(chosen_path.THRESHOLD, chosen_path.DEPTH, n) >= chosen_path.RECALL > chosen_path.met(chosen_path.THRESHOLD, chosen_path.DEPTH, n - 1)
    rng, sigs = random.Random(11), []
    for _ in range(300):  # pairs whose coordinates agree with probability 0.8, split three times
        a = [rng.getrandbits(32) for _ in range(chosen_path.K)]
        sigs.append((np.array([a], np.uint32), np.array([[x if rng.random() < 0.8 else rng.getrandbits(32) for x in a]], np.uint32)))
    found = 0
    for a, b in sigs:
        for r in range(n):
            paths = [set(), set()]
            for i, s in enumerate((a, b)):
                level = np.array([r + 1], np.uint64)
                for _ in range(chosen_path.DEPTH):
                    level = chosen_path.children(level, np.repeat(s, len(level), axis=0), chosen_path.THRESHOLD)[1]
                paths[i] = set(level.tolist())
            if paths[0] & paths[1]:
                found += 1
                break
    assert found >= 297


def test_many_equal_rows_and_null_ids_meet_once(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text)] * 700 + [(5, text + " and more")] * 700 + [(6, text + " or less")]
    got = chosen_path.join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r.doc_id, r.class_id, r.n_links, r.n_copies) for r in got} == {(None, 5, 2, 699), (5, 5, 2, 699), (6, 5, 2, 0)} and len(got) == 1401


def test_a_hot_star_keeps_its_component(spark):
    edges = [(0, i) for i in range(1, 2000)] + [(5000, 5001), (1999, 5000), (7000, 7001)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert found == {i: 0 for i in [*range(2000), 5000, 5001]} | {7000: 7000, 7001: 7000}


def test_recall_on_texts_just_above_the_threshold(spark):
    """600 pairs of texts with a similarity of 0.80 to 0.85, none near another: all are linked."""
    rng = random.Random(12)
    rows = []
    for pair in range(600):
        n = rng.randrange(60, 400)
        one = [f"w{rng.randrange(10**9)}" for _ in range(n)]
        two, changes = list(one), 0
        while True:  # change words until one more would take the pair below 0.8
            trial = list(two)
            trial[rng.randrange(5, n - 5)] = f"x{pair}_{changes}"
            a, b = shingles(" ".join(one)), shingles(" ".join(trial))
            if len(a & b) < 0.8 * len(a | b):
                break
            two, changes = trial, changes + 1
        a, b = shingles(" ".join(one)), shingles(" ".join(two))
        if changes and len(a & b) <= 0.85 * len(a | b):
            rows += [(2 * pair, " ".join(one)), (2 * pair + 1, " ".join(two))]
    assert len(rows) > 800
    found = {r.doc_id: (r.class_id, r.n_links) for r in chosen_path.join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    missed = sum(found[d] != (d // 2 * 2, 1) for d, _ in rows)
    assert missed == 0, f"{missed} of {len(rows)}"
