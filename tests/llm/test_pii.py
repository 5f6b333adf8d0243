import hashlib
import math
import re
import time
from collections import Counter

import pytest

from docmill.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(x) <= 255 for x in s.split("."))
    if kind == "phone":
        return 9 <= len(d) <= 15
    if kind == "card":
        return 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
    return True


def base(text):
    spans = sorted((m.start(), i, m.end(), k) for i, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if valid(k, m.group()))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


TRICKY = [
    "a@b.c_d@e.f g@h", "x.y+z@sub.mail-host.org. next@a.b", "1.2.3.4.5.6.7.8 999.1.2.3.4 0255.1.1.1 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111112 1  2 " + "1" * 40,
    "😀 +1 (168) 555-5254 é +12 3 +1..........2345678 +123456789012345678", "é@é.com ää@x.y 漢 10.0.0.1", "5500 0000 0000 0004 and 378282246310005, 6011-0009 9013-9424", "4111111111111111@card.io 4111 1111 1111 11111",
    "a" * 20000 + "@b.c", "@" * 3000, "1" * 30000, "1." * 10000, "a.b@" * 2000, "+1 " * 5000,
]


def test_base_spans_equal_plain_patterns(spark, documents):
    rows = [(i, t) for i, t in enumerate(TRICKY)] + [(1000 + r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: r for r in pii.detect(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, t in rows:
        want = base(t)
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (i, t[:80], want[:80], got[i].spans[:80])
        counts = [sum(s.startswith(k + ":") for s in want.split(",")) for k in BASE]
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == counts
        assert set(filter(None, want.split(","))) <= set(got[i].spans.split(","))


def test_added_spans_and_redaction(spark):
    texts = [f"Please call our office tel (412) 555-{n:04d} today" for n in range(1000, 1040)] + [f"contact mail me at person{n}@mail.example.com or tel +1 (412) 555-{n:04d}" for n in range(2000, 2040)] + ["version 111-111-1111 of", "nothing"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: r for r in pii.detect(docs).collect()}
    assert rows[0].spans == "number:27:41" and rows[0].n_added == 1
    assert rows[80].n_added == 0 and rows[81].spans == ""
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean[0] == "Please call our office tel [NUMBER] today"
    assert clean[40] == "contact mail me at [EMAIL] or tel [PHONE]"
    assert clean[81] == "nothing"


def test_edges_and_no_python(spark, edges, nothing):
    rows = pii.detect(edges)
    assert rows.count() == edges.count()
    assert not re.search("Python|Pandas|Arrow", rows._jdf.queryExecution().toString())
    assert pii.detect(nothing).count() == 0
    out = pii.redact(edges)
    assert out.columns == edges.columns
    assert sorted(map(str, out.select("doc_id", "text", "_t").collect())) == sorted(map(str, edges.select("doc_id", "text", "_t").collect()))


def plain_fit(counts):
    """EM and the classifier's fit by loops over {code: n}."""
    rows = [(n, [2 + 3 * j + code % 81 // 3**j % 3 for j in range(4)] + [14 + code // 81]) for code, n in sorted(counts.items())]
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    state = [0.0, *((-1.0, 0.0, 1.0) * 4)]
    posterior = lambda: [sigmoid(state[0] + sum(state[t - 1] for t in at[:4])) for _, at in rows]
    for _ in range(pii.EM_ROUNDS):
        post = posterior()
        yes, no = sum(n * r for (n, _), r in zip(rows, post)), sum(n * (1 - r) for (n, _), r in zip(rows, post))
        odds = []
        for t in range(2, 14):
            a, b = (sum(n * q for (n, at), q in zip(rows, qs) if t in at) for qs in (post, [1 - r for r in post]))
            odds.append(math.log((a + 1) / (yes + 3)) - math.log((b + 1) / (no + 3)))
        state = [math.log((yes + 1) / (no + 1)), *odds]
    post, total, w = posterior(), max(sum(n for n, _ in rows), 1.0), [0.0] * 20
    for _ in range(pii.FIT_ROUNDS):
        errors = [n / total * (sigmoid(w[0] + sum(w[t - 1] for t in at)) - r) for (n, at), r in zip(rows, post)]
        w = [x - pii.RATE * (sum(e for e, (_, at) in zip(errors, rows) if t == 1 or t in at) + pii.DECAY * x) for t, x in enumerate(w, 1)]
    return w


def test_weights_equal_plain_loops(spark, documents):
    rows = pii.candidates(documents).cache()
    counts = Counter(x.code for r in rows.collect() for x in [*r.base, *r.extra])
    assert len(counts) > 5
    assert pii.weights(rows) == pytest.approx(plain_fit(counts), rel=1e-6, abs=1e-9)


def test_many_matches_take_time_in_proportion(spark):
    n = 100_000
    texts = ["a@b.co " * n, "1.2.3.4 " * n, "Dr. Smith 412-555-1234 x@y.org " * (n // 4), "no data here " * n]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    start = time.time()
    rows = {r.doc_id: r for r in pii.detect(docs).collect()}
    assert [rows[i].n_email for i in range(4)] == [n, 0, n // 4, 0] and rows[1].n_ip == n
    for i in (0, 1):
        assert rows[i].base_sha256 == hashlib.sha256(base(texts[i]).encode()).hexdigest()
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean[0] == "[EMAIL] " * n and clean[1] == "[IP] " * n and clean[3] == texts[3] and clean[2].count("[EMAIL]") == n // 4
    assert time.time() - start < 120


def test_spans_that_base_ones_meet_are_dropped_and_places_hold(spark):
    pad = "é😀" * 700  # places beyond one block, in code points
    text = f"{pad} call tel 412-555-1234 or +1 (412) 555-1234 {pad} 4111 1111 1111 1111 {pad}"
    row = pii.candidates(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    spans = [(x.a, x.b) for x in row.base]
    assert all(not (a < x.b and x.a < b) for x in row.extra for a, b in spans) and [text[x.a : x.b] for x in row.extra] == ["412-555-1234"]
    assert [text[a:b] for a, b in spans] == ["+1 (412) 555-1234", "4111 1111 1111 1111"]


def long_shapes(n):
    return ["mail a@b" + ".c" * n + " x", "mail " + "a." * n + "a@b.com", "1" + ".1" * n, "4111" + " 1111" * n, "+1" + " (1)" * n, "412-555" + "-1234" * n, "Dr. A" + "b" * n + " C" * n, "a@b" + "-c.d" * n + "_", "x@y.z@" * n, "(412) " * n]


def test_no_repeated_group_overflows_a_stack(spark):
    small = long_shapes(1000)  # what the plain patterns can do
    long = spark.createDataFrame(list(enumerate(small + long_shapes(100_000))), "doc_id bigint, text string").repartition(4)
    start = time.time()
    rows = {r.doc_id: r for r in pii.detect(long).collect()}
    assert time.time() - start < 60
    for i, t in enumerate(small):
        assert rows[i].base_sha256 == hashlib.sha256(base(t).encode()).hexdigest(), t[:20]
    assert rows[10].spans == "email:5:200008" and [rows[10 + i].n_email for i in range(len(small))] == [rows[i].n_email for i in (0, 1, 2, 3, 4, 5, 6, 7)] + [rows[18].n_email, 0]
    assert pii.redact(spark.createDataFrame([(1, long_shapes(100_000)[0])], "doc_id bigint, text string")).first().text == "mail [EMAIL] x"
