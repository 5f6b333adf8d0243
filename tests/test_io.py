import hashlib
import json
import re
import sqlite3
import struct

import pytest
from pyspark.sql import functions as F

from docmill.operators import bundle, chunks, ordinals, vectors
from docmill.plans.markdown import decorated
from docmill.sources import readers, sinks
from docmill.streaming.ingest import ingest, lines_per_minute


def md(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.md").write_bytes(text.encode())


def test_markdown_corpora(spark, tmp_path):
    md(tmp_path / "a", **{"SE 1 (x)": "one\r\ntwo", "a+b": "x"})
    md(tmp_path / "b", WHO_ANCExSummary_2016="dup", c="y")
    (tmp_path / "a" / "note.txt").write_text("no")
    kept, skipped = readers.corpora(readers.markdown(spark, str(tmp_path / "a"), 0), readers.markdown(spark, str(tmp_path / "b"), 1))
    assert sorted(map(tuple, kept.collect())) == [(0, "SE 1 (x)", "one\ntwo"), (0, "a+b", "x"), (1, "c", "y")]
    assert [tuple(r) for r in skipped.collect()] == [("WHO_ANCExSummary_2016", "duplicate")]


def test_binary_scan_exclusion_and_bundle(spark, tmp_path):
    root = tmp_path / "raw"
    for name in ("x/A one.pdf", "x/b.PDF", "y/A one.pdf", "y/c.txt", "d.pdf"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(name.encode())
    docs = readers.pdfs(readers.binary_documents(spark, str(root)))
    assert sorted(r.rel_path for r in docs.collect()) == ["d.pdf", "x/A one.pdf", "x/b.PDF", "y/A one.pdf"]
    assert [r.source for r in readers.binary_documents(spark, str(root), "*.pdf", recursive=False).collect()] == ["d"]
    left = readers.without(docs, spark.createDataFrame([("d.pdf", "old")], "rel_path string, reason string"), "rel_path")
    assert left.count() == 3
    sources = spark.createDataFrame([("A one",), ("b",), ("gone",)], "source string")
    assert [r.source for r in bundle.unresolved(sources, docs).collect()] == ["gone"]
    entries = bundle.document_entries(bundle.resolve(sources, docs), docs)
    got = {r.source_id: r for r in entries.collect()}
    assert got["A one"].bundle_path == "docs/A_one.pdf" and got["A one"].file_size == len("x/A one.pdf")
    whole = json.loads(bundle.manifest(entries, bundle.artifact_entries(docs.where("rel_path = 'd.pdf'")), "v1").first()[0])
    assert whole["schema_version"] == 1 and len(whole["documents"]) == 2 and whole["artifacts"][0]["path"] == "d.pdf"
    assert bundle.collisions(spark.createDataFrame([("a b",), ("a_b",), ("c",)], "source string")).collect()[0][:] == ("a_b", 2)
    (root / "._bad").write_text("x")
    assert bundle.archive(str(root), str(tmp_path / "t.tgz")) == ["raw/._bad"]
    assert bundle.totals(docs).first().n_documents == 4


def test_package_fails_or_builds_a_checked_bundle(spark, tmp_path):
    for name in ("raw/x/A one.pdf", "raw/b.pdf", "raw/a/b.pdf", "raw/A_one.pdf", "store.sqlite", "passages.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    docs = readers.pdfs(readers.binary_documents(spark, str(tmp_path / "raw")))
    files = [("runtime/embeddings.sqlite", str(tmp_path / "store.sqlite")), ("debug/chunks_for_rag.txt", str(tmp_path / "passages.txt"))]

    def build(*sources, artifacts=files):
        entries = spark.createDataFrame([(f"[SOURCE:{s}|PAGE:1]\nx",) for s in sources], "entry string")
        return bundle.package(entries, docs, artifacts, str(tmp_path / "out"), "v1", producer="here")

    with pytest.raises(bundle.BundleError, match="without a document: gone"):
        build("b", "gone")
    with pytest.raises(bundle.BundleError, match="share: A_one"):
        build("A one", "A_one")
    with pytest.raises(bundle.BundleError, match="missing artefacts"):
        build("b", artifacts=[("x", str(tmp_path / "none"))])
    assert not (tmp_path / "out").exists()
    build("A_one")
    made = build("b", "b", "A one")  # replaces the one before
    root = tmp_path / "out" / "rag-bundle-v1"
    assert sorted(str(p.relative_to(root)) for p in root.rglob("*") if p.is_file()) == ["checksums.sha256", "debug/chunks_for_rag.txt", "docs/A_one.pdf", "docs/b.pdf", "manifest.json", "runtime/embeddings.sqlite"]
    assert (root / "docs" / "b.pdf").read_text() == "raw/a/b.pdf" and made["chunk_count"] == 3 and made["source_count"] == 2
    whole = json.loads((root / "manifest.json").read_text())
    assert [a["path"] for a in whole["artifacts"]] == [p for p, _ in files] and [d["source_id"] for d in whole["documents"]] == ["A one", "b"]
    lines = [x.split("  ") for x in (root / "checksums.sha256").read_text().splitlines()]
    assert [p for _, p in lines] == ["runtime/embeddings.sqlite", "debug/chunks_for_rag.txt", "docs/A_one.pdf", "docs/b.pdf", "manifest.json"]
    assert all(hashlib.sha256((root / p).read_bytes()).hexdigest() == digest for digest, p in lines)
    (tmp_path / "._odd").write_text("x")
    with pytest.raises(bundle.BundleError, match="forbidden"):
        build("b", artifacts=[("debug/._odd", str(tmp_path / "._odd"))])


def test_progress_sqlite_parts_and_markdown_files(spark, tmp_path):
    log = [
        (0, 1, "start"), (0, 2, "\r[##--] 12/ 2928   0.4%  elapsed 03:12  eta 04:22  SOURCE:a|PAGE:1\r[###-] 1234/ 2928  42.2%  elapsed 03:12  eta 04:22  " + "x" * 50), (0, 3, " \r "), (1, 1, "nothing yet"),
        (2, 1, None),
    ]
    got = {r.worker: tuple(r)[1:] for r in readers.progress(spark.createDataFrame(log, "worker int, seq int, line string")).collect()}
    assert got == {0: (1234, 2928, "04:22", "x" * 40), 1: (0, 0, "--:--", ""), 2: (0, 0, "--:--", "")}
    files = [str(tmp_path / f"part{i}.sqlite") for i in range(2)]
    for i, file in enumerate(files):
        with sqlite3.connect(file) as db:
            db.execute("CREATE TABLE part (seq INTEGER, text TEXT, blob BLOB)")
            db.executemany("INSERT INTO part VALUES (?, ?, ?)", [(n, f"t{n}", b"VF32" + bytes([n])) for n in range(i * 2, i * 2 + 2)])
    rows = readers.sqlite_rows(spark, files).orderBy("seq").collect()
    assert [(r.seq, r.text, bytes(r.blob), r.file) for r in rows] == [(n, f"t{n}", b"VF32" + bytes([n]), files[n // 2]) for n in range(4)]
    out = tmp_path / "md"
    docs = spark.createDataFrame([("a b", "one\ntwo"), ("c", None)], "source string, text string")
    sinks.export_markdown(docs, str(out))
    assert {p.name: p.read_text() for p in out.iterdir()} == {"a b.md": "one\ntwo", "c.md": ""}
    sinks.export_markdown(docs.withColumn("text", F.lit("new")), str(out), skip_existing=True)
    assert (out / "a b.md").read_text() == "one\ntwo"


def test_passage_file_round_trip(spark, tmp_path):
    docs = decorated(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20))
    made = chunks.dedup(chunks.chunks(docs)).cache()
    sinks.write_passages(made, str(tmp_path / "one"), one_file=True)
    want = [r.entry for r in chunks.prefixed(made).orderBy("index").collect()]
    assert [r.entry for r in readers.passages(spark, str(tmp_path / "one")).orderBy("file", "record_no").collect()] == want
    assert readers.count_separators(spark, str(tmp_path / "one")).first().n == len(want)
    assert readers.source_ids(readers.passages(spark, str(tmp_path / "one"))).count() == made.select("source").distinct().count()
    sinks.write_passages(made, str(tmp_path / "many"))
    assert [r.entry for r in readers.passages(spark, str(tmp_path / "many")).orderBy("file", "record_no").collect()] == want
    sinks.write_sidecar(made, str(tmp_path / "side"))
    rows = [json.loads(x) for f in sorted((tmp_path / "side").glob("*.json")) for x in f.read_text().splitlines()]
    assert [r["text"] for r in rows] == [e.split("\n", 1)[1] for e in want] and set(rows[0]) == set(sinks.SIDECAR)


def test_records(spark):
    text = "before\n<sep>[SOURCE:a|PAGE:1]\nbody [SOURCE:b|\n<sep>\n<sep>  \n<sep>x\nin <sep> line"
    assert spark.range(1).select(readers.records(F.lit(text)).alias("r")).first().r == ["before", "[SOURCE:a|PAGE:1]\nbody [SOURCE:b|", "x\nin <sep> line"]


def test_vectors(spark, tmp_path):
    rows = spark.createDataFrame([(1, [1.5, -0.0, float("nan")]), (2, []), (3, None)], "row_id bigint, v array<float>")
    got = {r.row_id: r for r in rows.withColumn("b", vectors.vf32_encode("v")).withColumn("d", vectors.vf32_decode("b")).collect()}
    assert bytes(got[1].b) == b"VF32" + struct.pack("<3f", 1.5, -0.0, float("nan")) and got[1].d[:2] == [1.5, 0.0] and got[2].d == [] and got[3].b is None
    e = vectors.embed(spark.createDataFrame([(1, "a b c"), (2, " "), (3, "a b c")], "row_id bigint, text string")).cache()
    ok = e.where("error IS NULL").withColumn("embeddings", vectors.vf32_encode("vector"))
    assert {len(r.embeddings) for r in ok.collect()} == {3076} and e.where("error IS NOT NULL").count() == 1
    assert tuple(vectors.outcome(e).first()) == (3, 2, 1) and [(r.row_id, r.error) for r in vectors.failed(e).collect()] == [(2, "no words")]
    assert sinks.export_sqlite(ok, str(tmp_path / "v.sqlite")) == 2
    assert sqlite3.connect(tmp_path / "v.sqlite").execute("SELECT rowid, text, length(embeddings) FROM rag_vector_store").fetchall() == [(1, "a b c", 3076), (2, "a b c", 3076)]
    assert spark.range(1).select(vectors.pad(F.array(F.lit(1), F.lit(2)), 3).alias("p")).first().p == [1, 2, 0]


def test_top_k_equals_brute_force(spark):
    import numpy as np

    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").limit(120).cache()
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in vectors.top_k(rows.where("vec_id % 20 = 0"), rows, 3).collect()}
    held = {r.vec_id: np.array(r.embedding, float) for r in rows.collect()}
    for q in (i for i in held if i % 20 == 0):
        score = sorted((-round(float(held[q] @ v / np.linalg.norm(held[q]) / np.linalg.norm(v)), 5), i) for i, v in held.items() if i != q)
        for k in range(3):
            assert abs(got[q, k + 1][1] + score[k][0]) < 2e-5


def test_numbers_are_dense_in_order(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 37 > 0, F.col("id") % 37).alias("k"), "id").repartition(7)
    got = [(r.n, r.k or 0, r.id) for r in ordinals.dense(ordinals.in_order(rows, "k", "id"), "n").orderBy("n").collect()]
    assert got == [(n, *x) for n, x in enumerate(sorted((i % 37, i) for i in range(1000)), 1)]
    assert ordinals.dense(ordinals.in_order(rows.limit(0), "k"), "n").count() == 0


def test_equal_keys_are_dealt_out(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else small partitions are put together again
    try:
        placed = ordinals.in_order(spark.range(0, 40_000, 1, 8).select(F.lit("one").alias("k"), "id"), "k")
        sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 4 and max(sizes) < 20_000


def test_incremental_ingest_takes_a_text_once(spark, tmp_path):
    body = "# Title\n" + "Some words that make a passage long enough to be kept as it is. " * 3
    md(tmp_path / "in", one=body, two="# Other\n" + "Different words that also make a passage of some length here. " * 3)
    run = lambda: ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"))
    run()
    assert sorted(r.source for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["one", "two"]
    md(tmp_path / "in", three=body, four="# Third\n" + "Entirely new text arrives later and makes one passage more than before. " * 2)
    run()
    run()
    assert sorted(r.source for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["four", "one", "two"]


def test_windowed_counts(spark):
    events = spark.createDataFrame([(0, "a"), (30, "a"), (61, "a"), (62, "b")], "s int, event_type string").select(F.timestamp_seconds("s").alias("ts"), "event_type")
    assert sorted((r.event_type, r.n) for r in lines_per_minute(events).collect()) == [("a", 1), ("a", 2), ("b", 1)]


def test_passage_files_are_read_in_splits(spark, tmp_path):
    import random

    rng = random.Random(6)
    texts = {
        "big.txt": "before the first\n" + "".join(f"<sep>[SOURCE:s{k}|PAGE:1]\n" + "word é <sep> no\n" * rng.randrange(4) + ("" if k % 9 else " \n<sep>\n\n") for k in range(6000)),
        "a b.txt": "<sep>one\n<sep>two\r\n<sep>  \n<sep>three", "plain.txt": "no separator\nat all", "empty.txt": "", "only.txt": "<sep>", "x.txt": " <sep>y\n\n\n<sep><sep>z\n",
    }
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    wanted = {}
    for name, text in texts.items():
        parts = [p.strip() for p in re.split(r"(?:^|\n)<sep>", text)]
        wanted |= {(name, n): p for n, p in enumerate(p for p in parts if p)}
    for most in ("4k", "64k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            out = readers.passages(spark, str(tmp_path)).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert len(out) == len(wanted) and {(r.file, r.record_no): r.entry for r in out} == wanted, most


def test_totals_come_with_the_write(spark, tmp_path):
    made = spark.range(1000).select(F.col("id").alias("index"), F.repeat(F.lit("é"), (F.col("id") % 50).cast("int")).alias("text"))
    found = sinks.write_counted(made, str(tmp_path / "p"))
    assert found == chunks.summary(made).first() and spark.read.parquet(str(tmp_path / "p")).count() == 1000
    assert sinks.write_counted(made.limit(0), str(tmp_path / "q"))[:] == (0, 0, 0)


def test_sqlite_parts_are_written_by_tasks(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") * 3 + 1).alias("row_id"), F.concat(F.lit("t"), "id").alias("text"), F.concat(F.lit("VF32"), "id").cast("binary").alias("embeddings")).repartition(5)
    for _ in range(2):  # a second export replaces the first
        listed = sinks.export_sqlite_parts(rows, str(tmp_path / "v"), parts=4).orderBy("first").collect()
    files = sorted(str(p) for p in (tmp_path / "v").iterdir())
    assert [r.file for r in listed] == files and len(files) == 4 and sum(r.n for r in listed) == 1000
    assert all(a.last < b.first for a, b in zip(listed, listed[1:]))
    back = readers.sqlite_rows(spark, files, "SELECT ROWID AS seq, text, embeddings AS blob FROM rag_vector_store").collect()
    assert sorted((r.seq, r.text, bytes(r.blob)) for r in back) == sorted((r.row_id, r.text, bytes(r.embeddings)) for r in rows.collect())
    assert sinks.export_sqlite_parts(rows.limit(0), str(tmp_path / "v")).count() == 0 and not list((tmp_path / "v").iterdir())


def test_archive_volumes_make_one_archive(spark, tmp_path):
    import io
    import tarfile

    held = [(f"docs/{'long name ' * (k % 30)}{k:03d} é.pdf", bytes([k % 256]) * (k * 37 % 3000)) for k in range(200)]
    files = spark.createDataFrame(held, "path string, content binary").repartition(3)
    volumes = bundle.archive_parts(files, str(tmp_path / "a"), parts=4)
    whole = b"".join(open(v, "rb").read() for v in volumes)
    with tarfile.open(fileobj=io.BytesIO(whole), mode="r:gz") as tar:
        assert {m.name: tar.extractfile(m).read() for m in tar.getmembers()} == dict(held)
    assert len(volumes) == 5 and b"".join(open(v, "rb").read() for v in bundle.archive_parts(files, str(tmp_path / "a"), parts=4)) == whole
    with pytest.raises(bundle.BundleError, match="forbidden"):
        bundle.archive_parts(spark.createDataFrame([("a/.DS_Store", b"")], files.schema), str(tmp_path / "b"))
    assert not (tmp_path / "b").exists()
