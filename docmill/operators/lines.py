"""Line-level operators: numbered lines, page carry-forward, headings, classes.

``source`` is the key of rows of lines: it must tell documents apart.  Where names repeat, use ``sections.folded``, which works on whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docmill.functions import text as T


def numbered(docs: DataFrame) -> DataFrame:
    """(source, ..., line_no, line): one row a physical line of ``text``, numbered from 0."""
    return docs.select(*[c for c in docs.columns if c != "text"], F.posexplode(T.lines(F.col("text"))).alias("line_no", "line"))


def paged(lines: DataFrame) -> DataFrame:
    """Carry page markers forward (page 1 before any) and drop the marker lines."""
    before = Window.partitionBy("source").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    marker = F.regexp_extract("line", T.PAGE_MARKER, 1)
    marked = lines.withColumn("_page", F.when(marker != "", marker.try_cast("int")))
    filled = marked.withColumn("page", F.coalesce(F.last("_page", ignorenulls=True).over(before), F.lit(1)))
    return filled.where(F.col("_page").isNull()).drop("_page")


def with_headings(lines: DataFrame) -> DataFrame:
    """Adds ``heading`` struct<level, raw, text>, null for other lines."""
    return lines.withColumn("heading", T.heading(F.col("line")))
