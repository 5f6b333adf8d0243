"""Token ids as fixed-width bit-packed binary files.

Ids come from the tokenizers library; a document ends with ``END_ID``.  A shard file is ``MAGIC``, then blocks of
``BLOCK_IDS`` ids at ``bits`` bits each (the fewest that hold the vocabulary), then a footer: the block offsets as
little-endian uint64 and a fixed tail (bits, ids, blocks).  An id's place follows from its number, so a reader unpacks any range
with numpy after reading only its blocks.

Documents are range-partitioned on doc_id, and on the text's 64-bit hash where ids are equal or null, before they are tokenised
(only text is shuffled), sorted within the partition, and each task writes one shard below the shared folder under a name of its own attempt; the rows it returns
name the file, so a repeated attempt leaves at most an unreferenced file.  Totals of shards, one row each, give every shard its
first position.

Defined results: a null text is empty, so it is one END_ID; rows of equal doc_id (null first) are ordered by their text's hash, and
each is a document of its own; ids that don't fit the width raise an error; an empty table writes no shards and returns no rows; extra columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import scratch, written
from docmill.llm.units import UnitIds

MAGIC = b"TKPACK01"
BLOCK_IDS = 1 << 16
END_ID = 0
TAIL = struct.Struct("<IQQ")


def width(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Little-endian bit string, ``bits`` for each id, padded to whole bytes."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {ids.max()} takes more than {bits} bits")
    if bits == 16:
        return ids.astype("<u2").tobytes()
    cells = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(cells.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(raw: bytes, bits: int, n: int) -> np.ndarray:
    if bits == 16:
        return np.frombuffer(raw, "<u2", n).astype(np.uint32)
    cells = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return cells.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


class Writer:
    def __init__(self, out, bits: int):
        self.out, self.bits, self.held, self.n_held, self.ids = out, bits, [], 0, 0
        self.offsets, self.at = [], len(MAGIC)
        out.write(MAGIC)

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        self.ids += len(ids)
        if self.n_held >= 8 * BLOCK_IDS:
            self._flush(False)

    def _flush(self, all_of_it: bool) -> None:
        x = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        whole = len(x) if all_of_it else len(x) // BLOCK_IDS * BLOCK_IDS
        for i in range(0, whole, BLOCK_IDS):
            raw = pack(x[i : min(i + BLOCK_IDS, whole)], self.bits)
            self.offsets.append(self.at)
            self.at += len(raw)
            self.out.write(raw)
        self.held, self.n_held = [x[whole:]], len(x) - whole

    def close(self) -> None:
        self._flush(True)
        self.out.write(np.array(self.offsets, "<u8").tobytes() + TAIL.pack(self.bits, self.ids, len(self.offsets)))


class Reader:
    """Random access to a shard."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - TAIL.size)
        self.bits, self.ids, blocks = TAIL.unpack(source.read(TAIL.size))
        self.end = size - TAIL.size - 8 * blocks
        source.seek(self.end)
        self.offsets = np.frombuffer(source.read(8 * blocks), "<u8").astype(np.int64)

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids start..stop-1."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK_IDS, (stop - 1) // BLOCK_IDS
        self.source.seek(int(self.offsets[first]))
        end = int(self.offsets[last + 1]) if last + 1 < len(self.offsets) else self.end
        n = min((last + 1) * BLOCK_IDS, self.ids) - first * BLOCK_IDS
        raw, out, at = self.source.read(end - int(self.offsets[first])), [], 0
        while n > 0:
            m = min(n, BLOCK_IDS)
            step = (m * self.bits + 7) // 8
            out.append(unpack(raw[at : at + step], self.bits, m))
            at, n = at + step, n - m
        return np.concatenate(out)[start - first * BLOCK_IDS : stop - first * BLOCK_IDS]


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def write(docs: DataFrame, folder: str, tokenizer: str, shards: int | None = None) -> DataFrame:
    """Write shards below ``folder`` and return the materialised index: doc_id, shard, path, first (within the shard), n_tokens."""
    schema = "doc_id bigint, shard int, path string, first bigint, n_tokens bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context, encode, out, at = TaskContext.get(), UnitIds.get(tokenizer), None, 0
        shard = context.partitionId()
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                fs, base = _open(folder)
                fs.create_dir(base, recursive=True)
                name = f"{base}/ids-{shard:06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.tkp"
                sink = fs.open_output_stream(name)
                out = Writer(sink, width(encode.size))
            counts = np.zeros(b.num_rows, np.int64)
            for r, text in enumerate(b.column(1)):
                ids = encode.text(text.as_py() or "")
                out.add(np.append(ids, np.uint32(END_ID)))
                counts[r] = len(ids) + 1
            first = at + np.cumsum(counts) - counts
            at += int(counts.sum())
            n = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.full(n, shard, np.int32)), pa.array([name] * n), pa.array(first), pa.array(counts)],
                ["doc_id", "shard", "path", "first", "n_tokens"],
            )
        if out is not None:
            out.close()
            sink.close()

    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    ordered = (picked.repartitionByRange(shards, "doc_id", "h") if shards else picked.repartitionByRange("doc_id", "h")).sortWithinPartitions("doc_id", "h", "text")
    return written(ordered.mapInArrow(run, schema), "token-index")


def read(index: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    from pyspark.sql import Window

    # One row a shard: its running total is a window over as many rows as there are files.
    totals = index.groupBy("shard", "path").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("path", F.coalesce(before, F.lit(0)).alias("base"))
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(folder)
        path, reader = None, None
        for b in batches:
            n = b.num_rows
            paths, first, count = b.column("path").to_pylist(), b.column("first").to_numpy(), b.column("n_tokens").to_numpy()
            sums = np.zeros(n, np.int64)
            i = 0
            while i < n:
                if paths[i] != path:
                    path, reader = paths[i], Reader(fs.open_input_file(paths[i]))
                j = i + 1  # neighbours in the file are read together, up to about a million ids
                while j < n and paths[j] == path and first[j] == first[j - 1] + count[j - 1] and first[j] - first[i] < 1 << 20:
                    j += 1
                ids = reader.read(int(first[i]), int(first[j - 1] + count[j - 1])).astype("<u4")
                for r in range(i, j):
                    o = int(first[r] - first[i])
                    sums[r] = zlib.crc32(ids[o : o + int(count[r])].tobytes())
                i = j
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(first + b.column("base").to_numpy()), pa.array(count), pa.array(sums)], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return index.join(F.broadcast(bases), "path").mapInArrow(run, schema)


def token_files(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write, read back, and report each document's place and checksum."""
    folder = folder or scratch(docs.sparkSession, "token-files")
    return read(write(docs, folder, tokenizer), folder)
