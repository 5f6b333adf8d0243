import hashlib
import re
import time

from pyspark.sql import functions as F

from docmill.llm.fill_middle import SQL, digests, fill_in_middle, restore


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plainly(doc_id, text, rate=100, spm=50, seed=7):
    """(n, form, prefix_chars, middle_chars, output) by the rule, a text at a time."""
    text = text or ""
    lines = re.findall("[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    one, two, three, four = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((one % (len(lines) + 1), two % (len(lines) + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or re.search("<[PSM]>", text) or three % 100 >= rate:
        return len(lines), "plain", None, None, text
    if four % 100 < spm:
        return len(lines), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(lines), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ODD = ["a<\nP>b\n<S\n>c<M\n", "\n\n\n", "x\r\ny\r\n", "a <P> b\nc", "<S>", "no break", "ends\n", "é漢😀\n line\x0b\n", "tail <\n<P\n<S\n", "a\x00b\nc\x00"] + [f"line {k} <\nS>{k}\n" * k for k in range(1, 40)]


def as_rows(frame):
    return [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in frame.collect()]


def test_equals_the_rule(spark, edges, documents):
    rows = [(k * 3, t) for k, t in enumerate(ODD)] + [(r.doc_id, r.text) for r in edges.collect()] + [(r.doc_id, r.text) for r in documents.collect()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    key = lambda r: (r[0] is None, r[0] or 0, str(r))
    for rate, spm, seed in ((100, 50, 7), (60, 0, 7), (0, 50, 7), (100, 100, 11)):
        made = fill_in_middle(docs, seed=seed, rate=rate, spm_rate=spm)
        assert sorted(as_rows(made), key=key) == sorted(((d, *plainly(d, t, rate, spm, seed)) for d, t in rows), key=key)
        back = sorted(((r.doc_id, r.restored) for r in restore(made).collect()), key=key)
        assert back == sorted(((d, t or "") for d, t in rows), key=key)


def test_query_digests(spark, edges, nothing):
    rows = sorted(edges.collect(), key=str)
    found = sorted((tuple(r) for r in digests(edges).collect()), key=str)
    wanted = []
    for r in rows:
        n, form, p, m, out = plainly(r.doc_id, r.text)
        wanted.append((r.doc_id, n, form, p, m, sha(out), sha(r.text or "")))
    assert found == sorted(wanted, key=str)
    assert digests(nothing).collect() == []


def test_equals_its_sql(spark, documents):
    import duckdb

    db = duckdb.connect()
    db.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    assert sorted(tuple(r) for r in digests(documents).collect()) == sorted(db.execute(SQL).fetchall())


def test_long_texts(spark):
    rows = spark.range(3).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("line é "), "id", F.lit("\n")), 300_000).alias("text"))
    start = time.time()
    assert restore(fill_in_middle(rows)).join(rows, "doc_id").where("restored = text AND form <> 'plain' AND n = 300000").count() == 3
    assert time.time() - start < 60
