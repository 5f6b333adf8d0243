"""Spelling variant grouping by a symmetric-delete join.

Words are maximal runs of letters, A-Z lower-cased.  Two words are near if exactly one code point inserted, deleted or replaced turns one into the
other.  A word's form is its near word of largest count, if that is at least ``FACTOR`` times its own; forms lead to roots.

1. Runs are counted by Spark's functions; each task counts its own before the shuffle, so frequent words gather nowhere.
2. Every word emits the hash of itself and of each of its distinct single deletions.  Two words at distance one always share a hash: the
   shorter is a deletion of the longer, or both lose the replaced place.  Hashes are joined with themselves; each pair that met is verified by
   its exact distance.  No pair of words meets by two of its deletions, so none is counted twice.
3. A word's partners are aggregated to their number and its form.  Counts at least double from form to form, so a chain has under 64 steps and no
   circle; roots are found by joins in which each word's known way doubles.

Hashes are polynomials over code points, so a word of L letters costs L steps, whatever its length; words of over ``LONG`` code points travel as
their digest and are put back where a pair of them is verified.  The words of one hash are those that one inserted letter makes of a common string (and that string), so
a group is bounded by the alphabet times the length, however large the corpus is.

Stages that are read twice are written to the shared folder.

Defined results: one row for each word of at least ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences; a null text has no words;
a null doc_id is hashed as the empty string; rows that repeat count each time; other columns are ignored, whatever their names; ties of
partners go to the smallest in code-point order; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import forget, written
from docmill.llm.shingles import mix

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 5
LEAST_COUNT = 3
FACTOR = 2
#: One run in so many, by a hash of document and run, loses a code point.
DAMAGED = 97
LONG = 64
#: Code points that are turned into hashes at once; a longer word is a step of its own.
STEP = 1 << 20
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 1 << 64)


def _damaged(doc_id: Column, run: Column) -> Column:
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % DAMAGED == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words that are long and frequent enough."""
    text = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    runs = docs.select(F.col("doc_id").alias("_id"), F.explode(F.regexp_extract_all(text, F.lit(f"[{LETTERS}]+"), F.lit(0))).alias("_run"))
    # A damaged run is one code point shorter.
    words = runs.where(F.length("_run") >= LEAST_LENGTH).select(_damaged(F.col("_id"), F.col("_run")).alias("word")).where(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def deletions(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``words``, hash) of each word and of its distinct single deletions.

    The hash of c_0 c_1 ... is the sum of c_j P^j, mixed.  Without c_i it is the sum before i, plus what follows over P.  Within a run of one
    letter all deletions are equal; the run's first stands for them."""
    size = np.array([len(w) for w in words])
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    first = np.cumsum(size) - size
    own = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(codes)) - first[own]
    up = np.full(int(size.max(initial=1)), _P, np.uint64)
    up[0] = 1
    np.multiply.accumulate(up, out=up)
    term = codes * up[place]
    through = np.cumsum(term)
    start = through[first] - term[first]
    total = through[first + size - 1] - start
    before = through - term - start[own]
    after = total[own] - before - term
    starts_run = np.ones(len(codes), bool)
    starts_run[1:] = (codes[1:] != codes[:-1]) | (place[1:] == 0)
    shorter = before + after * np.uint64(_PINV)
    # the length tells a string from a shorter one whose sum is the same
    hashes = np.concatenate((mix(total ^ mix(size.astype(np.uint64))), mix(shorter ^ mix((size - 1).astype(np.uint64))[own])[starts_run]))
    return np.concatenate((np.arange(len(words)), own[starts_run])), hashes


def _keys(words: DataFrame) -> DataFrame:
    """(key, name, n) of (name, n, word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            ends = np.cumsum([len(t) for t in texts])
            i = 0
            while i < len(texts):
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + STEP, "right")))
                row, key = deletions(texts[i:j])
                for lo in range(0, len(row), STEP):
                    at = pa.array(row[lo : lo + STEP] + i)
                    yield pa.RecordBatch.from_arrays([pa.array(key[lo : lo + STEP].view(np.int64)), b.column(0).take(at), b.column(1).take(at)], ["key", "name", "n"])
                i = j

    return words.select("name", "n", "word").mapInArrow(run, "key bigint, name string, n bigint")


def named(words: DataFrame) -> DataFrame:
    """Adds ``name`` to (word, n): the word, or the digest of a long one."""
    return words.withColumn("name", F.when(F.length("word") <= LONG, F.col("word")).otherwise(F.concat(F.lit("#"), F.sha2(F.col("word").cast("binary"), 256))))


def pairs(words: DataFrame) -> DataFrame:
    """(a, b, na, nb): names of near words a < b of ``named`` words, each pair once."""
    keys = _keys(words)
    met = keys.select("key", F.col("name").alias("a"), F.col("n").alias("na")).join(keys.select("key", F.col("name").alias("b"), F.col("n").alias("nb")), "key").where("a < b").drop("key")
    is_long = F.col("a").startswith("#") | F.col("b").startswith("#")
    short = met.where(~is_long & (F.levenshtein("a", "b", 1) == 1))
    texts = words.where(F.length("word") >= LONG)  # a long word's partner may be one shorter
    held = met.where(is_long).distinct().join(texts.select(F.col("name").alias("a"), F.col("word").alias("wa")), "a").join(texts.select(F.col("name").alias("b"), F.col("word").alias("wb")), "b")
    return short.unionByName(held.where(F.levenshtein("wa", "wb", 1) == 1).drop("wa", "wb"))


def partners(words: DataFrame) -> DataFrame:
    """(name, n_near, form, form_n) of the words that have near words."""
    met = written(pairs(words), "near")
    sides = met.select(F.col("a").alias("name"), F.col("na").alias("n"), F.struct((-F.col("nb")).alias("n"), F.col("b").alias("name")).alias("other"))
    sides = sides.union(met.select("b", "nb", F.struct(-F.col("na"), F.col("a"))))
    best, taken = F.col("best"), -F.col("best.n") >= FACTOR * F.col("n")
    near = sides.groupBy("name").agg(F.count("*").alias("n_near"), F.first("n").alias("n"), F.min("other").alias("best"))
    return near.select("name", "n_near", F.when(taken, best["name"]).alias("form"), F.when(taken, -best["n"]).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(name, root) of (name, form): the end of each chain of forms, found in twice as long steps each round."""
    known = written(forms.select("name", F.col("form").alias("root")), "roots")
    while True:
        onward = known.select(F.col("name").alias("root"), F.col("root").alias("next"))
        moved = written(known.join(onward, "root", "left").select("name", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        forget(known)
        known = moved.drop("moved")
        known.written_to = moved.written_to
        if moved.where("moved").isEmpty():
            return known


def group(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    words = written(named(counts(docs)), "words")
    near = written(partners(words), "partners")
    ends = roots(near.where("form IS NOT NULL"))
    rows = words.join(near, "name", "left").join(ends, "name", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0)))
    by_digest = F.coalesce(F.col("root").startswith("#") | F.col("form").startswith("#"), F.lit(False))
    spelt = rows.where(~by_digest)
    texts = words.where(F.length("word") > LONG).select("name", "word")
    long = rows.where(by_digest)
    for c in ("form", "root"):
        long = long.join(texts.select(F.col("name").alias(c), F.col("word").alias(f"_{c}")), c, "left").withColumn(c, F.coalesce(f"_{c}", c))
    out = spelt.unionByName(long.drop("_form", "_root"))
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The query's results in SQL.  CRC-32 goes over UTF-8 bytes with the table of its polynomial; the words' code points are under 256.
SQL = f"""
WITH RECURSIVE bits(k, step, c) AS (SELECT i, 0, i::UBIGINT FROM range(256) AS t(i)
    UNION ALL SELECT k, step + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END FROM bits WHERE step < 8),
crc AS (SELECT list(c ORDER BY k) AS t FROM bits WHERE step = 8),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[{LETTERS}]+')), '{UPPER}', '{LOWER}') AS run FROM documents),
met AS (SELECT doc_id, run, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || run AS label FROM runs WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL),
bytes AS (SELECT * EXCLUDE (label), flatten(list_transform(string_split(label, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [192 + unicode(x) // 64, 128 + unicode(x) % 64] END)) AS b FROM met),
hashed AS (SELECT run, n, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, b::UBIGINT[]), lambda c, x: xor(c // 256, t[(xor(c, x) % 256 + 1)::BIGINT]))) AS h FROM bytes, crc),
made AS (SELECT CASE WHEN h % {DAMAGED} = 0 THEN run[:(h % length(run))::BIGINT] || run[(h % length(run))::BIGINT + 2:] ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM made WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
keys AS (SELECT word, n, unnest(list_distinct(list_prepend(word, list_transform(range(1, length(word) + 1), lambda i: word[:i - 1] || word[i + 1:])))) AS key FROM words),
pairs AS (SELECT DISTINCT x.word, x.n, y.word AS other, y.n AS other_n FROM keys x JOIN keys y USING (key) WHERE x.word <> y.word AND CASE WHEN length(x.word) = length(y.word) THEN len(list_filter(range(1, length(x.word) + 1), lambda i: x.word[i] <> y.word[i])) = 1 ELSE key IN (x.word, y.word) END),
near AS (SELECT word, n, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM pairs GROUP BY ALL),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {FACTOR} * w.n THEN other END AS form, CASE WHEN other_n >= {FACTOR} * w.n THEN other_n END AS form_n FROM words w LEFT JOIN near USING (word)),
chains(word, upto, step) AS (SELECT word, word, 0 FROM formed UNION ALL SELECT c.word, f.form, step + 1 FROM chains c JOIN formed f ON f.word = c.upto WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(upto, step) AS root FROM chains GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""
