import random
import re

import time

from docmill.llm import decontaminate as D


def shingles(text):
    """Sets of five words by a way of their own: ASCII letters, digits, underscores and all beyond ASCII make words."""
    words = re.findall("[a-z0-9_\x80-\U0010ffff]+", text.lower())
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(docs, items, threshold=0.8):
    sets = {i: shingles(t or "") for i, t in items}
    out = []
    for d, t in docs:
        own = shingles(t or "")
        out += [(d, i, len(own & s), len(s)) for i, s in sets.items() if s and len(own & s) >= threshold * len(s) - 1e-9]
    return sorted(out, key=str)


def test_hits_equal_brute_force(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(500)]
    items = [(i, " ".join(rng.choice(words) for _ in range(n))) for i, n in enumerate([1, 3, 4, 5, 6, 9, 12, 13, 20, 40, 60, 200, 1000])]
    docs = []
    for d in range(200):
        own = [rng.choice(words) for _ in range(rng.randint(0, 800))]
        if d % 2:
            part = items[rng.randrange(len(items))][1].split()
            for _ in range(rng.randrange(3) * len(part) // 50 + (d % 4 == 3)):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randint(0, len(own))
            own[at:at] = part
        docs.append((d, (" " if d % 3 else "\n").join(own).upper() if d % 5 else " ".join(own)))
    found = D.hits(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted(((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in found.collect()), key=str) == brute(docs, items)


def test_blocks_agree(spark, documents, monkeypatch):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = sorted(map(tuple, D.hits(documents, items).collect()))
    monkeypatch.setattr(D, "BLOCK_ROWS", 300)
    assert sorted(map(tuple, D.hits(documents, items).collect())) == whole and whole
    left = {r.doc_id for r in D.clean(documents, items).collect()}
    assert left == {r.doc_id for r in documents.collect()} - {w[0] for w in whole}


def test_edges(spark, edges, nothing):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (4, "the cat sat on the mat"), (4, "and the dog ran after"), (None, "lorem ipsum lorem ipsum lorem ipsum")], "item_id bigint, text string")
    found = sorted((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in D.hits(edges, items).collect())
    assert found == [(4, 3, 1, 1), (7, 4, 3, 3), (8, 4, 3, 3), (8, 4, 3, 3)]
    assert D.hits(nothing, items).count() == 0 and D.hits(edges, items.limit(0)).count() == 0
    out = D.clean(edges, items)
    assert out.columns == edges.columns and out.count() == edges.count() - 4


def test_every_benchmark_text_is_an_item(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(20)) for c in "xy")
    rows = [(1, one), (1, two), (1, two), (None, one), (None, "Lone, item"), (2, "few words"), (3, "a b c d"), (4, "words"), (5, None), (6, "y3 y4 y5 y6 y7")]
    items = spark.createDataFrame(rows, "item_id bigint, text string")
    texts = [f"before {one} after", f"before {two} after", "here is a lone item in a long text", "too few words here, few words", "x a b c d e f g", "a b c", "few other words", "", None, "no match in this one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = [(0, 1, 16, 16), (0, None, 16, 16), (1, 1, 16, 16), (1, 6, 1, 1), (2, None, 1, 1), (3, 2, 1, 1), (3, 4, 1, 1), (4, 3, 1, 1), (6, 4, 1, 1)]
    found = D.hits(docs, items, each_text=True).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in found), key=str) == sorted(want, key=str)
    assert {r.doc_id for r in D.clean(docs, items, each_text=True).collect()} == {5, 7, 8, 9}
    assert D.hits(docs, spark.createDataFrame(rows[4:8], items.schema), each_text=True).count() == 5


def test_the_query_and_the_pipeline_search_every_text(spark, tmp_path):
    import corpus_pipeline
    from docmill.llm import registry

    text = " ".join(f"w{i}" for i in range(20))
    spark.createDataFrame([(1, f"start {text} end")], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(None, text)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [(r.doc_id, r.item_id) for r in registry.op10_decontaminate(spark, str(tmp_path)).collect()] == [(1, None)]
    assert corpus_pipeline.remove_benchmark(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path)).count() == 0


def test_items_with_a_common_opening(spark):
    """Hot shingles: openings that most items share, items that are little else, and a template with one word changed."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(2000)]
    opening = "choose the right answer of these four and say why".split()
    template = [rng.choice(words) for _ in range(40)]
    texts = [opening + [rng.choice(words) for _ in range(rng.randrange(1, 40))] for _ in range(300)] + [opening + [f"only{k}"] for k in range(100)]
    texts += [template[:20] + [f"v{k}"] + template[20:] for k in range(100)]
    items = [(k, " ".join(t)) for k, t in enumerate(texts)]
    docs = []
    for d in range(120):
        own = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
        part = list(rng.choice([opening, template, rng.choice(texts), rng.choice(texts)]))
        for _ in range(rng.randrange(3)):
            part[rng.randrange(len(part))] = "changed"
        docs.append((d, " ".join(own[:5] + part + own[5:])))
    found = D.hits(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted(((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in found.collect()), key=str) == brute(docs, items) != []


def test_a_common_opening_costs_little(spark):
    rng = random.Random(9)
    opening = "choose the right answer of these four below"
    items = [(k, opening + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(20))) for k in range(30_000)]
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(100)) for _ in range(2000)]
    docs = spark.createDataFrame([(d, f"{t} {opening}") for d, t in enumerate(texts)], "doc_id bigint, text string").repartition(4)
    index = D._indexes(spark.createDataFrame(items, "item_id bigint, text string"), 0.8, False)[0].value
    import pyarrow as pa

    start = time.process_time()
    assert len(index.search(pa.array([t.text for t in docs.collect()]))[0]) == 0
    assert time.process_time() - start < 4
