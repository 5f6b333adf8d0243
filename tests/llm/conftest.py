import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

EDGES = [
    (1, None, "en", "s"), (2, "", "en", "s"), (3, "   \n\t ", "en", "s"), (4, "one", None, None), (5, "Öl für é 漢字 😀", "de", "s"), (6, "12345 67890 !!", "en", "s"),
    (7, "the cat sat on the mat and the dog ran after it all day long", "en", "s"), (8, "the cat sat on the mat and the dog ran after it all day long", "en", "s"),
    (8, "the cat sat on the mat and the dog ran after it all day long", "en", "s"), (None, "no id here but words are there all the same", "en", None), (10, "lorem ipsum " * 20_000, "fr", "s"),
    (11, " double  space and trailing ", "en", "s"), (12, "x" * 5000, "en", "s"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


@pytest.fixture(scope="session")
def edges(spark):
    """Null, empty, blank, very long, repeated and odd texts, with extra columns of clashing names."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(EDGES, SCHEMA)
    for name in ("node", "row", "r", "id", "path", "sig", "spans", "base", "n", "_t", "token", "held_out", "score", "chunks"):
        rows = rows.withColumn(name, F.lit(name))
    return rows


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA + ", node string")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
