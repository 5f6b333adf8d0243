"""Personal data by weak supervision, in DataFrame functions only.

Base spans (email, ip, card, phone) come from fixed patterns and always stay.  Added candidates are numbers in telephone
groups without a plus, social-security shapes and names after a title.  Four labelers vote -1, 0 or 1 on every
candidate: a stricter pattern, a gazetteer (domains' last labels, dialling codes, card prefixes, reserved addresses, first names), the
words before it, and the variety of its characters.

Expectation-maximisation over the counts of vote patterns estimates each labeler's reliability (the odds of each vote among true and
false candidates) and every pattern's posterior.  A logistic span classifier over votes and kinds then learns those posteriors, and added
candidates with a probability of ``KEEP`` or more become spans.  There are at most 7 x 81 patterns at any input size: both fits fold
over that one array in SQL, and only the weights (20 numbers) come to the driver.

Matches are found leftmost and non-overlapping; where a pattern restricts itself by look-around (digit runs of 12 to 19
digits, starts of runs), it accepts the same matches as the plain one and stays linear on long runs.  Positions are running sums of the lengths of
matches and of the pieces between them, in code points; overlaps are told by running maxima, and what stands at a position is read from
blocks of ``BLOCK`` code points, so a text of many matches takes time in proportion (n log n for the running results).

Defined results: a null text is empty; no spans give empty strings (``base_sha256`` of the empty string); each row is its own
result; without any candidate the weights are 0 and nothing is added; extra columns are ignored by ``detect`` and kept by ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.functions.arrays import let, scan
from docmill.llm.common import written

KINDS = ("email", "ip", "card", "phone", "number", "ssn", "name")
BASE = 4
KEEP = 0.5
EM_ROUNDS, FIT_ROUNDS, RATE, DECAY = 25, 200, 2.0, 1e-3
CONTEXT = 24
BLOCK = 1024

#: (pattern, a cheap test that must hold for any match)
PATTERNS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda t: t.contains("@")),
    "ip": (r"(?=[0-9])(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda t: t.contains(".")),
    "card": (r"(?=[0-9])(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])", lambda t: F.lit(True)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: t.contains("+")),
    "number": (r"(?<![0-9+(.-])(?<![+0-9][\x20(])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9.-])", lambda t: F.lit(True)),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda t: t.contains("-")),
    "name": (r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra|Sr)\.? [A-Z][a-zà-ÿ]+(?: [A-Z][a-zà-ÿ]+)?", lambda t: F.lit(True)),
}
#: What a candidate must be beyond its pattern.  No pattern here or above repeats a group without a bound: Java's would take stack for each turn.
STRICT = {
    "email": r"^[A-Za-z0-9].*\.[A-Za-z]{2,8}$", "ip": r"^(?:[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$", "card": r"^[3-6][0-9]{3}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{3,4}$",
    "phone": r"^\+[1-9][0-9]{0,2}[ (.-].*[0-9]{3,4}$", "number": r"^\(?[2-9][0-9]{2}\)?[ .-][2-9][0-9]{2}[ .-][0-9]{4}$", "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$", "name": r"^\w+\. [A-Z]\S{2,}",
}
GAZETTEER = {
    "email": r"(?i)\.(?:com|org|net|edu|gov|io|info|biz|de|fr|es|it|uk|eu|ch|at|us|ca)$", "ip": r"^(?!0\.|10\.|127\.|192\.168\.|169\.254\.|172\.(?:1[6-9]|2[0-9]|3[01])\.|2[2-5][0-9]\.)", "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^\+(?:1|7|20|27|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])", "number": r"^\(?(?:[2-9][0-8][0-9])\)?", "ssn": r"^(?:[0-6][0-9]{2}|7[0-6][0-9]|77[0-2])",
    "name": r"(?i)\b(?:anna|maria|john|james|robert|mary|linda|michael|david|peter|paul|thomas|hans|karl|jean|pierre|marie|jose|juan|carlos|ana|smith|jones|brown|miller|schmidt|mueller|martin|garcia|lopez)\b",
}
CUES = {
    "email": r"mail|contact|write|address|reach|kontakt|correo", "ip": r"\bip\b|host|server|addr|client|from", "card": r"card|visa|master|credit|amex|karte|carte|tarjeta", "phone": r"tel|phone|call|fax|mobile|contact|ruf",
    "number": r"tel|phone|call|fax|mobile|contact|ruf", "ssn": r"ssn|social|security|sozial|securit", "name": r"name|dear|by|from|contact|signed|author",
}
AGAINST = r"version|\bv\.?$|order|invoice|serial|build|isbn|ticket|example|sample|rev\.?$"


def _found(text: Column, kind: str) -> Column:
    pattern, test = PATTERNS[kind]
    return F.when(test(text), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _placed(text: Column, found: Column, kind: str) -> Column:
    """array<struct<s, a, b>> of the matches."""
    gaps = F.slice(F.transform(F.split(text, PATTERNS[kind][0], -1), F.length), 1, F.size(found))
    ends = scan(F.zip_with(found, gaps, lambda s, g: F.length(s) + g), lambda before, own: before + own)
    spans = F.zip_with(found, ends, lambda s, b: F.struct(s.alias("s"), (b - F.length(s)).alias("a"), b.alias("b")))
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast("array<struct<s:string,a:int,b:int>>"))


def _blocks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def _between(blocks: Column, a: Column, b: Column) -> Column:
    """The code points a..b-1 of the text with these blocks."""
    i, j = F.floor(a / BLOCK).cast("int"), F.floor(b / BLOCK).cast("int")
    first = F.substring(F.get(blocks, i), a - i * BLOCK + 1, F.lit(BLOCK))
    last = F.coalesce(F.substring(F.get(blocks, j), F.lit(1), b - j * BLOCK), F.lit(""))
    inner = F.when(j > i + 1, F.array_join(F.slice(blocks, i + 2, F.greatest(j - i - 1, F.lit(0))), "")).otherwise("")
    return F.when(b <= a, "").when(i == j, F.substring(F.get(blocks, i), a - i * BLOCK + 1, b - a)).otherwise(F.concat(first, inner, last))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    d = F.reverse(_digits(s))
    total = F.aggregate(
        F.sequence(F.lit(0), F.length(d) - 1),
        F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 0, F.substring(d, i + 1, F.lit(1)).cast("int")).otherwise(F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substring(d, i + 1, F.lit(1)).cast("int") + 1)),
    )
    return total % 10 == 0


VALID = {
    "ip": lambda s: F.forall(F.split(s, r"\."), lambda p: F.coalesce(p.try_cast("bigint") <= 255, F.lit(False))),
    "card": _luhn,
    "phone": lambda s: F.length(_digits(s)).between(9, 15),
}


def _votes(kind: str, s: Column, before: Column) -> Column:
    """Code of the four votes, base 3."""
    strict = F.when(s.rlike(STRICT[kind]), 2).otherwise(0)
    gazetteer = F.when((F.regexp_replace(s, "[ -]", "") if kind == "card" else s).rlike(GAZETTEER[kind]), 2).otherwise(0)
    context = F.when(before.rlike(CUES[kind]), 2).when(before.rlike(AGAINST), 0).otherwise(1)
    kinds_of = F.size(F.array_distinct(F.split(F.regexp_replace(s, "[^0-9A-Za-z]", ""), "")))
    variety = F.when(kinds_of <= 3, 0).when(kinds_of >= 6, 2).otherwise(1)
    return ((strict * 3 + gazetteer) * 3 + context) * 3 + variety


def candidates(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the ``keep`` columns, the text's blocks ``_b``, base and extra: arrays of struct<a, kind, b, code>."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *keep, text.alias("_t"))
    rows = rows.select("*", *[_found(F.col("_t"), k).alias(f"_m_{k}") for k in KINDS])
    some = F.greatest(*[F.size(f"_m_{k}") for k in KINDS]) > 0
    rows = rows.select("doc_id", *keep, F.when(some, _blocks(F.col("_t"))).alias("_b"), *[_placed(F.col("_t"), F.col(f"_m_{k}"), k).alias(f"_p_{k}") for k in KINDS])

    def coded(kind: str) -> Column:
        spans = F.col(f"_p_{kind}")
        if kind in VALID:
            spans = F.filter(spans, lambda x: VALID[kind](x["s"]))
        number = KINDS.index(kind)

        def one(x: Column) -> Column:
            before = F.lower(_between(F.col("_b"), F.greatest(x["a"] - CONTEXT, F.lit(0)), x["a"]))
            return F.struct(x["a"].alias("a"), F.lit(number).alias("kind"), x["b"].alias("b"), (_votes(kind, x["s"], before) + 81 * number).alias("code"))

        return F.transform(spans, one)

    rows = rows.select("doc_id", *keep, "_b", F.concat(*[coded(k) for k in KINDS[:BASE]]).alias("base"), F.concat(*[coded(k) for k in KINDS[BASE:]]).alias("extra"))
    return rows.select("doc_id", *keep, "_b", F.array_sort("base").alias("base"), _free(F.col("base"), F.col("extra")).alias("extra"))


def _free(base: Column, extra: Column) -> Column:
    """The extra spans that no base span meets, in order: none before reaches into one, and none begins within it."""

    def apart(spans: Column) -> Column:
        reached = scan(F.transform(spans, lambda x: F.when(x["kind"] < BASE, x["b"]).otherwise(0)), F.greatest)
        begun = F.reverse(scan(F.reverse(F.transform(spans, lambda x: F.when(x["kind"] < BASE, x["a"]).otherwise((1 << 31) - 1))), F.least))
        return let(F.struct(reached.alias("r"), begun.alias("s")), lambda e: F.filter(spans, lambda x, i: (x["kind"] >= BASE) & (F.get(e["r"], i) <= x["a"]) & (F.get(e["s"], i) >= x["b"])))

    return F.when((F.size(base) > 0) & (F.size(extra) > 0), let(F.array_sort(F.concat(base, extra)), apart)).otherwise(F.array_sort(extra))


def weights(rows: DataFrame) -> list[float]:
    """Classifier weights [bias, 12 vote values, 7 kinds] fitted on all candidates' vote patterns."""
    codes = rows.select(F.explode(F.concat("base", "extra")).alias("x")).groupBy(F.col("x.code").alias("code")).agg(F.count("*").cast("double").alias("n"))
    votes = [(F.col("code") % 81 / 3**j).cast("int") % 3 for j in range(4)]
    index = F.array(*[2 + 3 * j + v for j, v in enumerate(votes)], F.lit(14) + (F.col("code") / 81).cast("int"))
    # At most 567 patterns: one array.
    table = codes.agg(F.array_sort(F.collect_list(F.struct("code", F.col("n"), index.alias("at")))).alias("rows"))

    def total(of: Column, fn) -> Column:
        return F.aggregate(of, F.lit(0.0), lambda acc, x: acc + fn(x))

    def linear(state: Column, at: Column) -> Column:
        return F.element_at(state, 1) + F.aggregate(at, F.lit(0.0), lambda acc, i: acc + F.element_at(state, i))

    def sigmoid(x: Column) -> Column:
        return 1 / (1 + F.exp(-x))

    def posteriors(state: Column) -> Column:
        return F.transform("rows", lambda r: F.struct(r["n"].alias("n"), r["at"].alias("at"), sigmoid(linear(state, F.slice(r["at"], 1, 4))).alias("r")))

    def em(state: Column, _: Column) -> Column:
        def maximise(post: Column) -> Column:
            def with_sums(sums: Column) -> Column:
                yes, no = sums["yes"], sums["no"]
                odds = F.transform(
                    F.sequence(F.lit(2), F.lit(13)),
                    lambda t: F.log((total(post, lambda p: F.when(F.array_contains(p["at"], t), p["n"] * p["r"]).otherwise(0.0)) + 1) / (yes + 3))
                    - F.log((total(post, lambda p: F.when(F.array_contains(p["at"], t), p["n"] * (1 - p["r"])).otherwise(0.0)) + 1) / (no + 3)),
                )
                return F.concat(F.array(F.log((yes + 1) / (no + 1))), odds)

            return let(F.struct(total(post, lambda p: p["n"] * p["r"]).alias("yes"), total(post, lambda p: p["n"] * (1 - p["r"])).alias("no")), with_sums)

        return let(posteriors(state), maximise)

    start = F.array(*[F.lit(x) for x in (0.0, *((-1.0, 0.0, 1.0) * 4))])
    fitted = table.select("rows", F.aggregate(F.sequence(F.lit(1), F.lit(EM_ROUNDS)), start, em).alias("state"))
    soft = fitted.select(posteriors(F.col("state")).alias("soft"))
    soft = soft.select("soft", F.greatest(total(F.col("soft"), lambda p: p["n"]), F.lit(1.0)).alias("all"))

    def descend(w: Column, _: Column) -> Column:
        def move(errors: Column) -> Column:
            return F.zip_with(
                w,
                F.sequence(F.lit(1), F.lit(20)),
                lambda x, t: x - RATE * (total(errors, lambda e: F.when((t == 1) | F.array_contains(e["at"], t), e["e"]).otherwise(0.0)) + DECAY * x),
            )

        return let(F.transform("soft", lambda p: F.struct(p["at"].alias("at"), (p["n"] / F.col("all") * (sigmoid(linear(w, p["at"])) - p["r"])).alias("e"))), move)

    final = soft.select(F.aggregate(F.sequence(F.lit(1), F.lit(FIT_ROUNDS)), F.array_repeat(F.lit(0.0), 20), descend).alias("w"))
    return list(final.first()["w"])


def _kept(w: list[float]) -> Column:
    """The extra candidates that the classifier accepts."""
    table = F.array(*[F.lit(float(x)) for x in w])

    def accepts(x: Column) -> Column:
        score = F.lit(float(w[0]))
        for j in range(4):
            score = score + F.element_at(table, 2 + 3 * j + (x["code"] % 81 / 3**j).cast("int") % 3)
        return 1 / (1 + F.exp(-(score + F.element_at(table, F.lit(14) + x["kind"])))) >= KEEP

    return F.filter("extra", accepts)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["a"].cast("string"), x["b"].cast("string"))), ",")


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans, n_added) of each row."""
    rows = written(candidates(docs).drop("_b"), "pii")
    rows = rows.withColumn("added", _kept(weights(rows)))

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    counts = [number(k) for k in range(BASE)]
    return rows.select(
        "doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
        (F.size("base") + F.size("added")).cast("bigint").alias("n_spans"), F.size("added").cast("bigint").alias("n_added"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; of overlapping spans the first covers the others.

    The candidates are found once and written beside the rows; only those of the texts that have some are read as blocks."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    held = docs.select("doc_id", "text", *[F.col(c).alias(f"_k_{i}") for i, c in enumerate(others)])
    rows = written(candidates(held.withColumn("_text", F.col("text")), "_text", *[f"_k_{i}" for i in range(len(others))]).drop("_b"), "pii-rows")
    spans = F.array_sort(F.concat("base", _kept(weights(rows))))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    rows = rows.withColumn("_s", spans).withColumn("_b", F.when(F.size("_s") > 0, _blocks(F.col("_text"))))

    def redacted(ends: Column) -> Column:
        def before(i: Column) -> Column:
            """How far the spans before the i-th reach."""
            return F.when(i == 0, 0).otherwise(F.get(ends, i - 1))

        parts = F.transform("_s", lambda x, i: F.when(x["a"] >= before(i), F.concat(_between(F.col("_b"), before(i), x["a"]), F.element_at(names, x["kind"] + 1))).otherwise(""))
        return F.concat(F.array_join(parts, ""), _between(F.col("_b"), F.element_at(ends, -1), F.length("_text")))

    reach = scan(F.transform("_s", lambda x: x["b"]), F.greatest)
    rows = rows.withColumn("text", F.when(F.size("_s") == 0, F.col("_text")).otherwise(let(reach, redacted)))
    back = {c: F.col(f"_k_{i}") for i, c in enumerate(others)} | {"doc_id": F.col("doc_id"), "text": F.col("text")}
    return rows.select(*[back[c].alias(c) for c in docs.columns])
