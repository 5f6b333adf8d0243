from collections import Counter

import duckdb
import pytest
from model import SF

from docmill import catalog

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations", "events", "nation"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    other = db.sql(catalog.ORACLE_SQL[name])
    assert sorted(other.columns) == columns
    assert {c: TYPES[t] for c, t in df.dtypes} == dict(zip(other.columns, map(str, other.types)))
    order = [other.columns.index(c) for c in columns]
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == Counter(tuple(row[i] for i in order) for row in other.fetchall())


#: What SQL doesn't express, with the tests that hold it against another way.
WITHOUT_SQL = {"q_html_markdown": "test_webpages.py", "q_ivf_topk": "test_ann.py"}


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL) | set(WITHOUT_SQL)


def test_entry_points_work_without_the_llm_folders(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    repo = Path(__file__).resolve().parent.parent
    shutil.copy(repo / "__spark_entry__.py", tmp_path)
    shutil.copytree(repo / "docmill", tmp_path / "docmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    assert said.stdout.split() == [str(len(catalog.QUERIES)), str(len(catalog.ORACLE_SQL))]
