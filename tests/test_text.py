import random
import re
import time

import model
import pytest
from pyspark.sql import functions as F

from docmill.functions import text as T
from docmill.functions.arrays import scan
from docmill.operators import pack


def each(spark, build, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", build(F.col("v")).alias("x")).orderBy("i").collect()
    return [r.x for r in rows]


CASES = [
    (T.lines, ["a\nb", "a\r\nb\n", "", "\n", "a\x0bb\u2028c\x85d"], [["a", "b"], ["a", "b"], [], [""], ["a", "b", "c", "d"]]),
    (T.strip_spans, ['x<span id="a"></span>y<span></span>', "<span>k</span>"], ["xy", "<span>k</span>"]),
    (T.page_marker_line, ["{0}" + "-" * 48, "{41}" + "-" * 48, "{0}" + "-" * 47, "{0}" + "-" * 49], ["<!-- page: 1 -->", "<!-- page: 42 -->", "{0}" + "-" * 47, "{0}" + "-" * 49]),
    (T.inline, ["[a b](u) <b>c</b>  *d* `e`~", "BP <90 and >60", "  x y "], ["a b c d e", "BP 60", "x y"]),
    (T.footer, ["Revision No. 3", "| Page iv of 20 |", "page 3 of 4 x", "**Page 3 of 4**", "___", ""], [True, True, False, True, False, False]),
    (T.table_artifact, ["", "|---|:--|", "| | |", "| a |", "--", "text"], [True, True, True, False, True, False]),
    (T.strip_footers, ["a\nRevision No. 3\n|---|\n| |\n\nb", "a\n\n\n\nb", "Page 1 of 2", "a\n| |\nb"], ["a\nb", "a\n\nb", "", "a\n| |\nb"]),
    (T.clean, ["x<sup>3</sup> y<br/>z <i>w</i> [p](#a) [q](b)  r"], ["x y z w p [q](b) r"]),
    (T.heading_key, ["**References:** ", ": A :"], ["references", "a"]),
    (T.line_class, ["", "| a |", "- x", "  12) y", "-x", "text", "|x"], ["blank", "table", "list", "list", "paragraph", "paragraph", "paragraph"]),
    (T.normalized_id, ["a b (c)", "__é.x-1__", "..", "()"], ["a_b_c", ".x-1", "..", ""]),
    (T.label, ["[SOURCE:a|PAGE:3]\nx", "x [SOURCE:a]"], ["SOURCE:a|PAGE:3", ""]),
]


@pytest.mark.parametrize("build,values,want", CASES, ids=[c[0].__name__ for c in CASES])
def test_text_functions(spark, build, values, want):
    assert each(spark, build, values) == want


def test_headings(spark):
    bold = lambda n: "**" + " ".join(["w"] * n) + "**"
    values = ["# a", "###### b *c*", "####### d", "#x", bold(2), bold(3), bold(18), bold(19), "**a b c.**", "**a b c:**", "**a b** and **c d**", " ## e ", "text"]
    got = each(spark, T.heading, values)
    assert [g and (g.level, g.text) for g in got] == [(1, "a"), (6, "b c"), None, None, None, (3, "w w w"), (3, " ".join(["w"] * 18)), None, None, (3, "a b c:"), (3, "a b and c d"), (2, "e"), None]


def test_windows():
    assert pack.windows(" short ", 7, 2) == [" short "]
    assert pack.windows("x" * 25, 10, 3) == ["x" * 10, "x" * 10, "x" * 10, "x" * 4]
    text = "aaaa bbbb. cccc\ndddd eeee\n\nffff gggg hhhh"
    for size, overlap in ((12, 3), (20, 5), (10, 10), (10, 15)):
        got = pack.windows(text, size, overlap)
        assert all(len(p) <= size and p == p.strip() and p in text for p in got)
        assert text.split()[-1].endswith(got[-1].split()[-1])
    assert pack.windows("aaaa. bbbb cc", 10, 2) == ["aaaa.", ". bbbb cc"]


def test_windows_equal_their_definition():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(["a", "bc", " ", ". ", "\n", "\n\n", "."]) for _ in range(rng.randint(0, 90)))
        size, overlap = rng.randint(1, 25), rng.randint(0, 12)
        assert pack.windows(text, size, overlap) == model.windows(text, size, overlap), (text, size, overlap)


def test_running_results(spark):
    rows = spark.createDataFrame([([3, 1, None, 5, 2],), ([],), ([None, 4],), (list(range(1000)),)], "v array<int>")
    got = [r.x for r in rows.select(scan(F.col("v"), lambda a, b: F.coalesce(b, a)).alias("x")).collect()]
    assert got == [[3, 1, 1, 5, 2], [], [None, 4], list(range(1000))]
    assert rows.select(scan(F.col("v"), lambda a, b: a + b).alias("x")).collect()[3].x == [i * (i + 1) // 2 for i in range(1000)]


def test_long_lists_and_footers_take_time_in_proportion(spark):
    n = 100_000
    lines = "\n".join(f"- item {i}" if i % 5 else "Revision No. 3\n|---|" for i in range(n))
    start = time.time()
    cleaned = spark.createDataFrame([(lines,)], "t string").select(T.clean(F.col("t")).alias("c")).first().c
    assert cleaned == "\n".join(f"- item {i}" for i in range(n) if i % 5)
    rows = [f"- item {i}" for i in range(n)]
    pieces = pack.item_pieces(rows, list(range(n)), 800)
    assert "\n".join(pieces) == "\n".join(rows) and max(map(len, pieces)) <= 800
    cells = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.struct(i.cast("string").alias("text"))).alias("pieces"))
    assert pack.pack(cells, "pieces", F.lit("# H"), 800).select(F.size(F.flatten("groups")).alias("n")).first().n == n
    assert time.time() - start < 60


def test_breadcrumb_and_render(spark):
    row = spark.range(1).select(
        T.breadcrumb(F.array(F.lit("A"), F.lit("B"), F.lit("C"))).alias("a"), T.breadcrumb(F.array(F.lit("A"))).alias("b"), T.rendered(F.lit("# H"), F.lit(" x ")).alias("c"), T.rendered(F.lit(None).cast("string"), F.lit("x")).alias("d"), T.rendered(F.lit("# H"), F.lit(" ")).alias("e"),
    ).first()
    assert tuple(row) == ("> A > B", None, "# H\n\nx", "x", "# H")


def plain_clean(t):
    t = re.sub(r"(?i)<br\s*/?>", " ", re.sub(r"(?is)<sup[^>]*>.*?</sup>", "", t)) if "<" in t else t
    return re.sub(r"\[([^\]]+)\]\(#[^)]*\)", r"\1", re.sub("<[^>]+>", "", t))


def test_tags_links_and_spans_equal_plain_patterns(spark):
    rng = random.Random(9)
    parts = ["<", ">", "a", " ", "<b>", "<span>", "<span ", "</span>", "[", "]", "(", ")", "](", "](#", "<sup", "<sup>", "</sup>", "<SUP x>", "</Sup>", "<br>", "<BR />", "\n", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(24))) for _ in range(20_000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    t = F.col("t")
    found = rows.select("i", T.untagged(t, " "), T.unlinked(t), T.unlinked(t, "#[^)]*+"), T.strip_spans(t), T.span_count(t), T.without_superscripts(t), T.inline(t)).collect()
    for i, *got in found:
        x = texts[i]
        span = r"<span[^>]*></span>"
        want = [re.sub("<[^>]+>", " ", x), re.sub(r"\[([^\]]+)\]\([^)]+\)", r"\1", x), re.sub(r"\[([^\]]+)\]\(#[^)]*\)", r"\1", x), re.sub(span, "", x), len(re.findall(span, x)), re.sub(r"(?is)<sup[^>]*>.*?</sup>", "", x), model.plain(x)]
        assert got == want, x
    # no line of these is a footer or a blank run, so cleaning is the patterns and the white space
    single = [re.sub(r"\s+", " ", x) for x in texts]
    cleaned = each(spark, T.clean, single)
    assert cleaned == [re.sub(r"[ \t]{2,}", " ", plain_clean(x).strip()) for x in single]


SHAPES = ["a < b ", "<", "<span ", "[", "<sup ", "<sup>", "[a](", "[a] ", "](#", "[](", "<br ", "<>", "](", "<span>", "|<", "[a](b ", "<sup></sup", "** ", "*a_"]


@pytest.mark.parametrize("end", ["", ">", "</sup>", ")", "]", "](#x)"])
def test_removal_takes_time_in_proportion(spark, end):
    """A megabyte of each shape; none takes over two seconds."""
    texts = [(shape * (1_000_000 // len(shape)) + end,) for shape in SHAPES]
    rows = spark.createDataFrame(texts, "t string").repartition(4)
    start = time.time()
    rows.select(T.clean(F.col("t")), T.inline(F.col("t")), T.strip_spans(F.col("t")), T.span_count(F.col("t"))).write.format("noop").mode("overwrite").save()
    assert time.time() - start < 2 * len(SHAPES) / 4 + 5
