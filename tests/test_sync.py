import pytest
from pyspark.sql import functions as F

from docmill.operators import chunks
from docmill.sources.readers import markdown
from docmill.streaming import sync as S


def put(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        path = folder / f"{name}.md"
        if text is None:
            path.unlink()
        else:
            path.write_text(text)


def body(word, n=1):
    return "".join(f"# Part {k}\n" + f"{word} stands here with enough words around it to make a passage of eighty characters. \n" for k in range(n))


def live(spark, target):
    return sorted((r.source, r.section_no, r.text) for r in S.passages(spark, target).collect())


def whole(spark, folder, *but):
    docs = markdown(spark, str(folder)).select("source", "text").where(~F.col("source").isin(list(but) or ["-"]))
    return sorted((r.source, r.section_no, r.text) for r in chunks.passages(docs).collect())


def test_add_change_delete_and_copies(spark, tmp_path):
    folder, target = tmp_path / "in", str(tmp_path / "out")
    put(folder, a=body("alpha", 2), b=body("beta"), c=body("alpha", 2))
    assert S.sync(spark, str(folder), target) == {"add": 2, "change": 0, "keep": 0, "delete": 0}
    assert live(spark, target) == whole(spark, folder, "c")
    assert S.sync(spark, str(folder), target) == {"add": 0, "change": 0, "keep": 2, "delete": 0}
    put(folder, b=body("better", 3), d=body("delta"))
    assert S.sync(spark, str(folder), target) == {"add": 1, "change": 1, "keep": 1, "delete": 0}
    assert live(spark, target) == whole(spark, folder, "c")
    put(folder, a=None)  # its copy takes its place
    assert S.sync(spark, str(folder), target) == {"add": 1, "change": 0, "keep": 2, "delete": 1}
    assert live(spark, target) == whole(spark, folder)
    put(folder, b=None, c=None, d=None)
    assert S.sync(spark, str(folder), target) == {"add": 0, "change": 0, "keep": 0, "delete": 3}
    assert live(spark, target) == []


def test_a_run_that_dies_is_done_again(spark, tmp_path, monkeypatch):
    folder, target = tmp_path / "in", str(tmp_path / "out")
    put(folder, a=body("alpha"), b=body("beta"))
    S.sync(spark, str(folder), target)
    before = live(spark, target)
    put(folder, a=body("other", 2), b=None, e=body("epsilon"))
    real = chunks.passages

    def dies_late(docs, config):
        real(docs, config).write.mode("overwrite").parquet(f"{target}/passages/version=1")  # the passages are there, the state isn't
        raise RuntimeError("lost")

    monkeypatch.setattr(S.chunks, "passages", dies_late)
    with pytest.raises(RuntimeError):
        S.sync(spark, str(folder), target)
    assert live(spark, target) == before
    monkeypatch.setattr(S.chunks, "passages", real)
    assert S.sync(spark, str(folder), target) == {"add": 1, "change": 1, "keep": 0, "delete": 1}
    assert live(spark, target) == whole(spark, folder)
