"""Release bundles: source resolution, id collisions, manifests, checksums, archives."""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import shutil
import tarfile
import uuid
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from docmill.functions.text import normalized_id
from docmill.sources.readers import source_ids

BAD_ENTRY = r"(^|/)\._|(^|/)\.DS_Store$|^__MACOSX/"
# Fixed values of the manifest's format.
EMBEDDING = {"model": "Gecko_1024_quant (TFLite)", "dimensions": 768, "blob_format": "VF32", "blob_bytes": 3076}
SOURCE_IDS = {
    "format": "chunk SOURCE stem", "pdf_naming": "<normalized_source_id>.pdf",
    "normalization": "re.sub(r'[^A-Za-z0-9\\-.]', '_', stem) -> collapse '_+' -> strip edges", "page_index_base": 1,
}


class BundleError(ValueError):
    """A bundle that must not be released."""


def resolve(sources: DataFrame, documents: DataFrame) -> DataFrame:
    """Each source with its first document by path, null without one."""
    first = documents.groupBy("source").agg(F.min("rel_path").alias("rel_path"))
    return sources.join(first, "source", "left")


def unresolved(sources: DataFrame, documents: DataFrame) -> DataFrame:
    return sources.join(documents.select("source").distinct(), "source", "left_anti")


def collisions(sources: DataFrame) -> DataFrame:
    """(normalized_id, n) of ids that several sources share."""
    return sources.groupBy(normalized_id(F.col("source")).alias("normalized_id")).agg(F.count_distinct("source").alias("n")).where("n > 1")


def document_entries(resolved: DataFrame, documents: DataFrame) -> DataFrame:
    """(source_id, normalized_id, bundle_path, file_size, sha256)."""
    name = normalized_id(F.col("source"))
    return resolved.join(documents.drop("source"), "rel_path").select(
        F.col("source").alias("source_id"), name.alias("normalized_id"), F.concat(F.lit("docs/"), name, F.lit(".pdf")).alias("bundle_path"), F.col("length").alias("file_size"), F.sha2("content", 256).alias("sha256")
    )


def artifact_entries(files: DataFrame) -> DataFrame:
    """(position, path, file_size, sha256); ``position`` is their order in the bundle, 0 where they have none."""
    position = F.col("position") if "position" in files.columns else F.lit(0)
    return files.select(position.cast("int").alias("position"), F.col("rel_path").alias("path"), F.col("length").alias("file_size"), F.sha2("content", 256).alias("sha256"))


def manifest(documents: DataFrame, artifacts: DataFrame, version: str, commit: str = "unknown", producer: str = "", n_passages: int | None = None) -> DataFrame:
    """One row, one JSON column: documents by source, artefacts by position.  A bundle lists files of one release, not rows of the corpus."""
    d = documents.select(F.struct("source_id", "normalized_id", "bundle_path", "file_size", "sha256").alias("d"))
    a = artifacts.select(F.struct("position", "path", "file_size", "sha256").alias("a"))
    both = d.unionByName(a, allowMissingColumns=True).agg(F.array_sort(F.collect_list("a")).alias("_a"), F.array_sort(F.collect_list("d")).alias("documents"))
    plain = F.transform("_a", lambda x: F.struct(x["path"].alias("path"), x["file_size"].alias("file_size"), x["sha256"].alias("sha256")))

    def fixed(values: dict) -> Column:
        return F.struct(*[F.lit(v).alias(k) for k, v in values.items()])

    whole = F.struct(
        F.lit(1).alias("schema_version"), F.lit(version).alias("bundle_version"), F.lit(producer).alias("producer_repo"), F.lit(commit).alias("producer_commit"), F.lit(n_passages).cast("bigint").alias("chunk_count"),
        F.size("documents").alias("source_count"), fixed(EMBEDDING).alias("embedding"), fixed(SOURCE_IDS).alias("source_id_contract"), plain.alias("artifacts"), F.col("documents").alias("documents"),
    )
    return both.select(F.to_json(whole, {"ignoreNullFields": "false"}).alias("manifest"))


def checksums(entries: DataFrame, path: str) -> DataFrame:
    """``sha256  path`` lines."""
    return entries.select(F.concat_ws("  ", "sha256", path).alias("line"))


def bad_entries(listing: DataFrame) -> DataFrame:
    return listing.where(F.col("path").rlike(BAD_ENTRY))


def archive(folder: str, target: str) -> list[str]:
    """Write a gzipped tar on the driver and return its forbidden entries, which must be none."""
    import re

    with tarfile.open(target, "w:gz") as tar:
        tar.add(folder, arcname=Path(folder).name)
    with tarfile.open(target) as tar:
        return [n for n in tar.getnames() if re.search(BAD_ENTRY, n)]


def archive_parts(files: DataFrame, folder: str, parts: int | None = None) -> list[str]:
    """Write (path, content) files as volumes of one gzipped tar, by tasks that share ``folder``; returns the volumes in order, the end mark last.

    A volume is a gzip member with the blocks of a range of paths, so the volumes one after the other (``cat``) are the archive, and none goes through the
    driver.  Forbidden entries raise BundleError before anything is written.  Equal files give equal volumes."""
    none_of(bad_entries(files.select("path")), "forbidden entries")
    Path(folder).mkdir(parents=True, exist_ok=True)
    for old in Path(folder).glob("volume-*.tar.gz"):
        old.unlink()

    def written(name: str, blocks: Iterator[bytes]) -> str:
        part = Path(folder) / f".{uuid.uuid4().hex}.part"
        with part.open("wb") as raw, gzip.GzipFile(fileobj=raw, mode="wb", filename="", mtime=0) as out:
            for block in blocks:
                out.write(block)
        os.replace(part, Path(folder) / name)
        return str(Path(folder) / name)

    def store(number: int, rows: Iterator[Row]) -> Iterator[str]:
        def blocks(first: Row) -> Iterator[bytes]:
            for row in chain([first], rows):
                info = tarfile.TarInfo(row.path)
                info.size = len(row.content)
                yield info.tobuf(tarfile.PAX_FORMAT)
                yield bytes(row.content) + b"\0" * (-len(row.content) % tarfile.BLOCKSIZE)

        first = next(rows, None)
        if first is not None:
            yield written(f"volume-{number:06d}.tar.gz", blocks(first))

    ranged = files.select("path", "content")
    ranged = ranged.repartitionByRange(parts, "path") if parts else ranged.repartitionByRange("path")
    # Per-partition imperative work: a volume is open while its files go by.
    volumes = sorted(ranged.sortWithinPartitions("path").rdd.mapPartitionsWithIndex(store).collect())  # one name a volume
    return [*volumes, written("volume-end.tar.gz", iter([b"\0" * (2 * tarfile.BLOCKSIZE)]))]


def totals(documents: DataFrame) -> DataFrame:
    return documents.agg(F.count("*").alias("n_documents"), F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("bytes"))


def none_of(rows: DataFrame, what: str) -> None:
    """Raises with the first rows where there are any."""
    found = rows.orderBy(rows.columns[0]).take(20)
    if found:
        raise BundleError(f"{what}: " + ", ".join(str(r[0]) for r in found))


def _file(path: Path) -> tuple[int, str]:
    with path.open("rb") as f:
        return path.stat().st_size, hashlib.file_digest(f, "sha256").hexdigest()


def package(entries: DataFrame, documents: DataFrame, artifacts: list[tuple[str, str]], folder: str, version: str, commit: str = "unknown", producer: str = "") -> dict:
    """Build and check the release ``rag-bundle-<version>`` below ``folder``, which tasks and driver share; returns what the manifest says
    and the archive's path and digest.

    ``entries`` are the passage file's records, ``documents`` (rel_path, source, length, content), ``artifacts`` (path in the bundle, file).
    Raises BundleError, before anything is written, where an artefact is missing, a source has no document, or two sources share a
    normalised id; and where the archive holds forbidden entries.  An earlier bundle of the version is replaced.  Tasks write the documents
    under another name first, so a task that runs twice does no harm."""
    none = [str(f) for _, f in artifacts if not Path(f).is_file()]
    if none:
        raise BundleError("missing artefacts: " + ", ".join(none))
    ids = source_ids(entries)
    none_of(unresolved(ids, documents), "sources without a document")
    none_of(collisions(ids), "normalised ids that several sources share")

    root = Path(folder) / f"rag-bundle-{version}"
    if root.exists():
        shutil.rmtree(root)
    for name in ("docs", *{str(Path(p).parent) for p, _ in artifacts}):
        (root / name).mkdir(parents=True, exist_ok=True)
    resolved = resolve(ids, documents)

    def store(rows: Iterator[Row]) -> None:
        for row in rows:
            part = root / "docs" / f"{uuid.uuid4().hex}.part"
            part.write_bytes(row.content)
            os.replace(part, root / "docs" / f"{row.name}.pdf")

    resolved.join(documents.drop("source"), "rel_path").select(normalized_id(F.col("source")).alias("name"), "content").foreachPartition(store)
    held = []
    for i, (path, file) in enumerate(artifacts):
        shutil.copy2(file, root / path)
        held.append((i, path, *_file(root / path)))
    listed = entries.sparkSession.createDataFrame(held, "position int, path string, file_size bigint, sha256 string")
    whole = json.loads(manifest(document_entries(resolved, documents), listed, version, commit, producer, entries.count()).first()[0])
    (root / "manifest.json").write_text(json.dumps(whole, indent=2, ensure_ascii=False) + "\n")
    sums = [(a["sha256"], a["path"]) for a in whole["artifacts"]] + [(d["sha256"], d["bundle_path"]) for d in whole["documents"]]
    sums.append((_file(root / "manifest.json")[1], "manifest.json"))
    (root / "checksums.sha256").write_text("".join(f"{digest}  {path}\n" for digest, path in sums))

    target = root.parent / f"{root.name}.tar.gz"
    bad = archive(str(root), str(target))
    if bad:
        raise BundleError("forbidden entries: " + ", ".join(bad))
    return whole | {"archive": str(target), "archive_sha256": _file(target)[1]}
