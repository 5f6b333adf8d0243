import re
import string
import zlib
from collections import Counter

from pyspark.sql import functions as F

from docmill.llm.spelling import SQL, deletions, group

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plainly(rows):
    """{word: (form, root, n, n_near, form_n)} by trying every edit of every word."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 3}
    letters = sorted({x for w in words for x in w})

    def near(w):
        out = set()
        for i in range(len(w) + 1):
            out |= {w[:i] + x + w[i:] for x in letters}
            if i < len(w):
                out |= {w[:i] + x + w[i + 1 :] for x in letters} | {w[:i] + w[i + 1 :]}
        return (out - {w}) & words.keys()

    form, n_near = {}, {}
    for w, n in words.items():
        others = near(w)
        n_near[w] = len(others)
        best = min(others, key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 2 * n:
            form[w] = best
    out = {}
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, n_near[w], words.get(form.get(w)))
    return out


def found(docs):
    rows = group(docs).collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_equals_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert found(documents) == plainly(rows)


ODD = [
    (1, "aaaab aaaab aaaab aaaaa aaaaa aaaaa aaaa aaaa aaaa aaaaaa"), (2, "AAAAA aaaaa aaaaa aaaaaa aaaaaa aaaaaa aaaaab"), (3, "étude etude étude etude étude Étude Étude Étude ETUDE"), (4, "straße stra×e stra÷e " * 3),
    (5, "abcde abcdf abdce " * 3 + "abcde " * 9), (5, "abcde abcdf abdce " * 3 + "abcde " * 9), (None, "colour color colours " * 4 + "colour " * 30), (7, None), (8, ""), (9, "a bb ccc dddd 1abcd2 _abcd_ abcd'e KKelvin "),
    (10, "honour honour honour honor " * 5 + "honors honour's honours " * 3), (11, ("x" * 70 + " ") * 3 + ("x" * 69 + "y ") * 8 + ("x" * 71 + " ") * 4 + ("y" + "x" * 70 + " ") * 20), (12, ("ab" * 32 + " ") * 3 + ("ab" * 32 + "a ") * 9 + ("ab" * 33 + " ") * 40),
]


def test_odd_words(spark):
    docs = spark.createDataFrame(ODD, "doc_id bigint, text string").withColumn("word", F.lit("w")).withColumn("n", F.lit(1)).withColumn("name", F.lit("#")).withColumn("key", F.lit(2))
    wanted = plainly(ODD)
    assert any(len(w) > 64 and v[0] for w, v in wanted.items()) and len({v[1] for v in wanted.values()}) < len(wanted)
    assert found(docs) == wanted


def test_edges(edges, nothing):
    assert found(edges) == plainly([(r.doc_id, r.text) for r in edges.collect()])
    assert group(nothing).collect() == []


def test_very_long_words(spark):
    one, two = "ab" * 60_000, "ab" * 60_000 + "c"
    docs = spark.createDataFrame([(k, f"{one} {two} {two}") for k in range(1, 7)], "doc_id bigint, text string")
    out = found(docs)
    assert out[one][0] == two and out[one][1:] == (two, 6, 1, 12) and out[two] == (None, two, 12, 1, None)


def test_deletions_are_those_of_a_plain_loop():
    words = ["aabbcc", "abcde", "zzzzz", "éàéàé", "aaaaab"]
    row, key = deletions(words)
    by_text = {}
    for k, w in enumerate(words):
        own = {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}
        assert (row == k).sum() == len(own)
        for t in own:
            by_text.setdefault(t, set()).add(k)
    by_key = {}
    for r, h in zip(row.tolist(), key.tolist()):
        by_key.setdefault(h, set()).add(r)
    assert sorted(map(sorted, by_key.values())) == sorted(map(sorted, by_text.values()))


def test_equals_its_sql(spark, documents):
    import duckdb

    db = duckdb.connect()
    db.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    key = lambda r: r[0]
    assert sorted((tuple(r) for r in group(documents).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=key) == sorted(db.execute(SQL).fetchall(), key=key)
