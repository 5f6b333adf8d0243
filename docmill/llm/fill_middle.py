"""Fill-in-the-middle transformation: DuckDB SQL over each Arrow batch.

A text is cut into lines (a line keeps its line break), a prefix, a middle and a suffix of whole lines are chosen by a hash of the
document's id, and the parts are put out with the middle last, so that a left-to-right model learns to fill a gap.

* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
* ``plain``: the text as it is; an empty text, one that holds a marker itself, and those that the rate leaves out.

Each batch is registered with a DuckDB connection of the task and comes back as Arrow; no Python code sees a row.  A batch goes in
steps of at most ``STEP_BYTES`` of text or one text, which bounds a task's memory; tasks keep no state.  Choices depend on the id
and the text only, so a task that runs again gives the same rows.

``restore`` rebuilds the text from the output and its form.  No marker begins within another one, and plain texts aside no text holds one, so
the first of each is the one that was put there.

Defined results: one row for each input row, in its place; a null text is the empty text; a null doc_id is hashed as the empty string;
rows that repeat give equal rows; columns that aren't named here are ignored, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import steps, utf8

SEED = 7
RATE = 100
SPM_RATE = 50
STEP_BYTES = 4 << 20

LINE = "[^\\n]*\\n|[^\\n]+"
MADE = """
WITH hashed AS (SELECT *, sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM (SELECT doc_id, coalesce(text, '') AS text FROM {table})),
cut AS (SELECT *, regexp_extract_all(text, '{line}') AS lines, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM hashed),
placed AS (SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a, greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {rate} THEN 'plain' WHEN h4 % 100 < {spm} THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (SELECT *, array_to_string(list_slice(lines, 1, a), '') AS prefix, array_to_string(list_slice(lines, a + 1, b), '') AS middle, array_to_string(list_slice(lines, b + 1, n), '') AS suffix FROM placed)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output
FROM parts
"""
#: A form's text from its output: what follows the first marker is split at the other two.
RESTORED = """
SELECT * EXCLUDE (inner_marker, rest, head, tail), CASE form WHEN 'plain' THEN output WHEN 'psm' THEN head || tail[strpos(tail, '<M>') + 3:] || tail[:strpos(tail, '<M>') - 1]
    ELSE tail[:strpos(tail, '<M>') - 1] || tail[strpos(tail, '<M>') + 3:] || head END AS restored
FROM (SELECT *, rest[:strpos(rest, inner_marker) - 1] AS head, rest[strpos(rest, inner_marker) + 3:] AS tail
    FROM (SELECT *, output[4:] AS rest, CASE form WHEN 'psm' THEN '<S>' ELSE '<P>' END AS inner_marker FROM ({made})))
"""
DIGESTS = "SELECT doc_id, n, form, prefix_chars, middle_chars, sha256(output) AS output_sha256, sha256(restored) AS restored_sha256 FROM ({rows})"


def _sql(table: str, seed: int, rate: int, spm_rate: int) -> str:
    return MADE.format(table=table, seed=seed, rate=rate, spm=spm_rate, line=LINE)


def _mapped(rows: DataFrame, sql: str, schema: str, measure: int) -> DataFrame:
    """``sql`` over table ``t`` for each step of each batch; ``measure`` is the column whose bytes bound a step."""
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        with duckdb.connect(config={"threads": 1, "memory_limit": "800MB"}) as db:
            db.execute("SET preserve_insertion_order = true")
            for batch in batches:
                for i, j in steps(utf8(batch.column(measure))[0], STEP_BYTES):
                    db.register("t", pa.Table.from_batches([batch.slice(i, j - i)]))
                    made = db.execute(sql).to_arrow_table().select(names)
                    db.unregister("t")
                    yield from made.to_batches()

    return rows.mapInArrow(run, schema)


def _picked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


MADE_SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): of 100 documents about ``rate`` are transformed, of these ``spm_rate`` of 100 as spm."""
    return _mapped(_picked(docs), _sql("t", seed, rate, spm_rate), MADE_SCHEMA, 1)


def restore(rows: DataFrame) -> DataFrame:
    """``fill_in_middle`` rows with ``restored``, the exact text."""
    return _mapped(rows.select(*[f.strip().split(" ")[0] for f in MADE_SCHEMA.split(",")]), RESTORED.format(made="SELECT * FROM t"), MADE_SCHEMA + ", restored string", 5)


def digests(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """Digests of each document's output and of the text rebuilt from it."""
    rows = restore(fill_in_middle(docs, seed, rate, spm_rate))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


#: The query's results by one statement over the whole table.
SQL = DIGESTS.format(rows=RESTORED.format(made=_sql("documents", SEED, RATE, SPM_RATE)))
