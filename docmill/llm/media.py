"""Media columns in a content-defined chunk store.

A payload is cut where a rolling gear hash of its last 32 bytes has its top ``BITS`` bits zero, with chunks of ``LEAST`` to ``MOST`` bytes, so
equal passages give equal chunks wherever they stand.  Each task appends the zstandard frames of the chunks that are new to it to one
pack file in the shared folder; no payload is ever shuffled.  Spark then joins on chunk digests: of the copies of a chunk in
several packs the first (by pack, offset) is the one that all recipes point at, and equal payloads share one recipe.
``compact`` rewrites packs without chunks that no recipe points at.

Reading follows the recipes: sorted by place, each task reads frames by pack and offset, checks every chunk's
SHA-256, and joins them to the payload, whose SHA-256 must be the recipe's.

The stored form of a payload is its recipe (count; then digest, raw and stored length of each chunk) followed by its frames.

Pack names hold the attempt, and only returned rows refer to them: a task that runs twice leaves at most an unread file.

Defined results: a null text is the empty payload; payloads are padded with bytes 255 to a positive multiple of
``UNIT``; equal texts get equal values; rows repeat as they come; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.bitpack import _open
from docmill.llm.common import scratch, steps, utf8, written
from docmill.llm.shingles import mix

UNIT = 576
LEAST, MOST, BITS = 1024, 16384, 11
LEVEL = 3
#: Payload bytes that one task reads back.
READ = 1 << 25
GEAR = (mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def padded(raw: bytes, unit: int = UNIT) -> bytes:
    return raw + b"\xff" * (max(unit, -(-len(raw) // unit) * unit) - len(raw))


def candidates(data: np.ndarray) -> np.ndarray:
    """Positions after which the gear hash allows a cut."""
    h = GEAR[data]
    for d in (1, 2, 4, 8, 16):  # doubling: the hash of the last 2d bytes from two of d
        h[d:] += h[:-d] << np.uint32(d)
    return np.flatnonzero(h >> np.uint32(32 - BITS) == 0) + 1


def cuts(payload: bytes) -> list[int]:
    """Ends of the payload's chunks."""
    n, out, at = len(payload), [], 0
    if n > LEAST:
        for c in candidates(np.frombuffer(payload, np.uint8)).tolist():
            while c - at > MOST:
                at += MOST
                out.append(at)
            if c - at >= LEAST and c < n:
                out.append(c)
                at = c
    while n - at > MOST:
        at += MOST
        out.append(at)
    return [*out, n]


def store(docs: DataFrame, folder: str) -> DataFrame:
    """Write packs below ``folder``; the materialised index has a row for each document: doc_id, n_bytes, payload_sha256,
    chunks(digest, pack, offset, stored, raw)."""
    kind = "array<struct<digest:binary,pack:string,offset:bigint,stored:int,raw:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context, press = TaskContext.get(), zstandard.ZstdCompressor(level=LEVEL).compress
        at, sink, name, known = 0, None, "", {}
        for b in batches:
            bounds, data = utf8(b.column(1))
            for i, j in steps(bounds):
                n_bytes, sums, lists = [], [], []
                for r in range(i, j):
                    raw = data[bounds[r] : bounds[r + 1]].tobytes()
                    payload, chunks, start = padded(raw), [], 0
                    for end in cuts(payload):
                        chunk = payload[start:end]
                        start, digest = end, hashlib.sha256(chunk).digest()
                        place = known.get(digest)
                        if place is None:
                            if sink is None:
                                fs, base = _open(folder)
                                fs.create_dir(base, recursive=True)
                                name = f"pack-{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.cdc"
                                sink = fs.open_output_stream(f"{base}/{name}")
                            frame = press(chunk)
                            sink.write(frame)
                            place = known[digest] = {"digest": digest, "pack": name, "offset": at, "stored": len(frame), "raw": len(chunk)}
                            at += len(frame)
                        chunks.append(place)
                    n_bytes.append(len(raw))
                    sums.append(hashlib.sha256(payload).digest())
                    lists.append(chunks)
                chunk_type = pa.list_(pa.struct([("digest", pa.binary()), ("pack", pa.string()), ("offset", pa.int64()), ("stored", pa.int32()), ("raw", pa.int32())]))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(n_bytes, pa.int64()), pa.array(sums, pa.binary()), pa.array(lists, chunk_type)], ["doc_id", "n_bytes", "payload", "chunks"])
        if sink is not None:
            sink.close()

    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(picked.mapInArrow(run, f"doc_id bigint, n_bytes bigint, payload binary, chunks {kind}"), "media-index")


def recipes(index: DataFrame) -> DataFrame:
    """(payload, chunks) of each distinct payload, every chunk at its one canonical place."""
    distinct = index.groupBy("payload").agg(F.min("chunks").alias("chunks"))
    parts = distinct.select("payload", F.posexplode("chunks").alias("seq", "chunk"))
    place = F.struct("chunk.pack", "chunk.offset", "chunk.stored", "chunk.raw")
    canonical = index.select(F.explode("chunks").alias("chunk")).groupBy("chunk.digest").agg(F.min(place).alias("place"))
    joined = parts.select("payload", "seq", F.col("chunk.digest").alias("digest")).join(canonical, "digest")
    return joined.groupBy("payload").agg(F.sort_array(F.collect_list(F.struct("seq", "digest", "place.pack", "place.offset", "place.stored", "place.raw"))).alias("chunks"))


class Packs:
    """Frames by pack and offset; keeps a few files open."""

    def __init__(self, folder: str):
        self.fs, self.base = _open(folder)
        self.files: dict = {}

    def frame(self, pack: str, offset: int, stored: int) -> bytes:
        f = self.files.get(pack)
        if f is None:
            if len(self.files) >= 64:
                self.files.pop(next(iter(self.files))).close()
            f = self.files[pack] = self.fs.open_input_file(f"{self.base}/{pack}")
        return f.read_at(stored, offset)

    def payload(self, want: bytes, chunks: list[dict]) -> tuple[bytes, bytes]:
        """(payload, stored form); raises unless every digest holds."""
        head, frames, raw = [struct.pack("<I", len(chunks))], [], []
        for c in chunks:
            frame = self.frame(c["pack"], c["offset"], c["stored"])
            chunk = zstandard.ZstdDecompressor().decompress(frame, max_output_size=MOST)
            if hashlib.sha256(chunk).digest() != c["digest"]:
                raise ValueError(f"chunk {c['digest'].hex()} is damaged in {c['pack']}")
            head.append(c["digest"] + struct.pack("<II", len(chunk), len(frame)))
            frames.append(frame)
            raw.append(chunk)
        whole = b"".join(raw)
        if hashlib.sha256(whole).digest() != want:
            raise ValueError(f"payload {want.hex()} doesn't reconstruct")
        return whole, b"".join(head + frames)


def feature(payload: bytes) -> str:
    """Level, spread and eight-bin spectrum of the payload's 8-bit samples."""
    h = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    n, v = int(h.sum()), np.arange(256)
    total, squares = int(h @ v), int(h @ (v * v))
    mean = total / n
    return f"mean={mean:.4f};std={max(0.0, squares / n - mean * mean) ** 0.5:.4f};bins=" + "/".join(map(str, h.reshape(8, 32).sum(axis=1).tolist()))


def features(recipe_rows: DataFrame, folder: str, parts: int | None = None) -> DataFrame:
    """Read every payload back: payload, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, n_chunks."""
    schema = "payload binary, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string, n_chunks bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs = Packs(folder)
        for b in batches:
            rows = []
            for want, chunks in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                whole, form = packs.payload(want, chunks)
                rows.append((want, len(whole), hashlib.sha256(whole).hexdigest(), zlib.crc32(whole[-32:]), len(form), hashlib.sha256(form).hexdigest(), feature(whole), len(chunks)))
            kinds = [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            columns = zip(*rows) if rows else [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [s.split()[0] for s in schema.split(", ")])

    # Dealt by payload, as many may begin with one chunk, into parts by the bytes to read and not by the recipes' size.
    last = F.element_at("chunks", -1)
    placed = recipe_rows.repartition(parts, "payload") if parts else recipe_rows.repartition("payload")
    return placed.sortWithinPartitions(last["pack"], last["offset"]).mapInArrow(run, schema)


def compact(recipe_rows: DataFrame, folder: str, to: str) -> DataFrame:
    """Copy the chunks that recipes point at into new packs below ``to``; returns recipes with the new places."""
    live = recipe_rows.select(F.explode("chunks").alias("c")).select("c.digest", "c.pack", "c.offset", "c.stored", "c.raw").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context, packs, sink, at = TaskContext.get(), Packs(folder), None, 0
        for b in batches:
            offsets = []
            for pack, offset, stored in zip(b.column("pack").to_pylist(), b.column("offset").to_pylist(), b.column("stored").to_pylist()):
                if sink is None:
                    fs, base = _open(to)
                    fs.create_dir(base, recursive=True)
                    name = f"pack-{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.cdc"
                    sink = fs.open_output_stream(f"{base}/{name}")
                sink.write(packs.frame(pack, offset, stored))
                offsets.append(at)
                at += stored
            if offsets:
                yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array([name] * len(offsets)), pa.array(offsets, pa.int64())], ["digest", "pack", "offset"])
        if sink is not None:
            sink.close()

    moved = written(live.repartition("pack").sortWithinPartitions("pack", "offset").mapInArrow(run, "digest binary, pack string, offset bigint"), "media-moved")
    parts = recipe_rows.select("payload", F.explode("chunks").alias("c")).select("payload", "c.seq", "c.digest", "c.stored", "c.raw").join(moved, "digest")
    return parts.groupBy("payload").agg(F.sort_array(F.collect_list(F.struct("seq", "digest", "pack", "offset", "stored", "raw"))).alias("chunks"))


def round_trip(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Store every payload, read it back, and report its values by document."""
    folder = folder or scratch(docs.sparkSession, "media-packs")
    index = store(docs, folder)
    size = index.select(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    found = features(recipes(index), folder, max(1, -(-size // READ)))
    return index.select("doc_id", "n_bytes", "payload").join(found, "payload").drop("payload")
