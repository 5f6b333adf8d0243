"""Byte-level BPE encoding and decoding, run as DuckDB queries inside each Spark partition.

Encoding.  A text is cut into the pattern's pieces.  A piece that is a vocabulary entry is its id; every other distinct piece
becomes token-position rows, one per byte, and a recursive query joins neighbours to the merge table (all pairs whose
concatenation is an entry) and contracts each piece's leftmost minimum-rank pair until none is left.

A piece of over ``LONG`` bytes is contracted in blocks of that size, and mended where they meet: tokens are a text's encoding if, and
only if, every two neighbours, contracted as a text of their own, stay as they are (the first contraction across a border
would happen there, too).  Neighbours at a border that don't stay are contracted again with ``REACH`` tokens on each side, then with twice as many, until
all borders hold.  So a long word takes time in proportion to its length.  What is contracted at once and is still over ``WIDE`` bytes (as a run of one character may be)
contracts, in one round, all non-overlapping occurrences of the minimum pair, left to right, wherever no merge with the new token can rank
lower (else only the leftmost): the same contractions in the same order, in fewer rounds.

Decoding.  A document's ids are replaced by the vocabulary's bytes and an aggregation in the list's order concatenates them.

Units repeat, so a worker process keeps the ids of the units it has met, about ``MOST`` of them; units lie between spaces that a
non-space follows, as such a space always begins a piece.  The memory of a task is bounded by that, one Arrow
batch's step and one text.  Tasks keep no state that a lost executor could take along.

Defined results: null text encodes like the empty text (no ids, SHA-256 of the empty string); each row is its own result;
extra columns are ignored by ``encode_decode``; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import steps, utf8

#: White_Space of Unicode; the ``regex`` module's ``\s`` has four control characters more.
SPACE = "\t-\r \x85\xa0  -     　"
#: A space that begins no piece for sure, and the cut before those that do.
ODD_SPACE, CUT = re.compile(r" (?!\S)").search, re.compile(r" (?=\S)").split
LONG, WIDE, REACH = 64, 2048, 4
MOST = 600_000
#: Token positions that one recursive query holds, squared by piece: the bound of its work and memory.
WORK = 8_000_000

STEP = """
WITH RECURSIVE t(w, ids) USING KEY (w) AS (
  SELECT w, ids FROM start
  UNION ALL
  SELECT t.w, ids[:(best & 4294967295)] || [best >> 32] || ids[(best & 4294967295) + 3:]
  FROM t JOIN (SELECT w, min((c << 32) | p) AS best
               FROM (SELECT w, unnest(ids) AS tok, unnest(ids[2:]) AS nxt, unnest(range(len(ids))) AS p FROM t) x
               JOIN merges m ON m.ab = (tok << 32) | nxt GROUP BY w) b ON b.w = t.w
)
SELECT w, ids FROM t
"""

STEP_LONG = """
WITH RECURSIVE t AS (
  SELECT 0 AS it, w, unnest(range(len(ids))) AS pos, unnest(ids) AS tok FROM start
  UNION ALL
  SELECT it + 1, w, pos, CASE WHEN hit THEN best >> 32 ELSE tok END
  FROM (SELECT *, lag(hit) OVER (PARTITION BY w ORDER BY pos) AS gone
        FROM (SELECT *, CASE WHEN unsafe THEN pos = (best & 4294967295) ELSE occ AND (i - min(i) OVER (PARTITION BY w, occ, run)) % 2 = 0 END AS hit
              FROM (SELECT *, i - row_number() OVER (PARTITION BY w, occ ORDER BY pos) AS run
                    FROM (SELECT y.*, c IS NOT NULL AND c = (best >> 32) AS occ, row_number() OVER (PARTITION BY w ORDER BY pos) AS i,
                                 (best >> 32) IN (SELECT c FROM unsafe) AS unsafe
                          FROM (SELECT x.*, c, min((c << 32) | pos) OVER (PARTITION BY w) AS best
                                FROM (SELECT it, w, pos, tok, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS nxt FROM t) x
                                LEFT JOIN merges m ON m.ab = (x.tok << 32) | x.nxt) y
                          WHERE best IS NOT NULL))))
  WHERE gone IS DISTINCT FROM true
)
SELECT w, list(tok ORDER BY pos) AS ids FROM (SELECT *, max(it) OVER (PARTITION BY w) AS last FROM t) WHERE it = last GROUP BY w
"""

DECODE = "SELECT d, list_aggregate(list_transform(ids, lambda i: entries[i + 1]), 'string_agg', '') AS text FROM docs, vocabulary"


def white_space(pattern: str) -> str:
    """``pattern`` with its space classes spelled out."""
    return pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")


class Memo:
    """Values of units met: ``rest`` by the unit without the space before it, ``first`` those that begin a text, ``other``
    pieces that begin with no space."""

    def __init__(self):
        self.first: dict = {}
        self.rest: dict = {}
        self.other: dict = {}

    def trim(self) -> None:
        for d, most in ((self.rest, MOST), (self.first, MOST // 10), (self.other, MOST // 10)):
            if len(d) > most:
                d.clear()

    def piece(self, p: str):
        return self.rest.get(p[1:]) if p[0] == " " and len(p) > 1 else self.other.get(p)

    def keep(self, p: str, value) -> None:
        if p[0] == " " and len(p) > 1:
            self.rest[p[1:]] = value
        else:
            self.other[p] = value


class Engine:
    """One process's DuckDB connection with vocabulary and merges."""

    _one: dict[tuple[str, str], "Engine"] = {}

    @classmethod
    def get(cls, ranks: str, pattern: str) -> "Engine":
        if (ranks, pattern) not in cls._one:
            cls._one[ranks, pattern] = cls(ranks, pattern)
        return cls._one[ranks, pattern]

    def __init__(self, ranks: str, pattern: str):
        import duckdb
        import regex

        with open(ranks, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pieces = regex.compile(white_space(pattern)).findall
        self.word = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch  # letters only: one piece
        # What a query can't hold in its limit goes to the task's own temporary folder.
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "256MB", "temp_directory": os.path.join(tempfile.gettempdir(), f"duckdb-{os.getpid()}")})
        ab, c = [], []
        for token, r in self.rank.items():
            for k in range(1, len(token)):
                a, b = self.rank.get(token[:k]), self.rank.get(token[k:])
                if a is not None and b is not None:
                    ab.append(a << 32 | b)
                    c.append(r)
        self._table("merges", ab=pa.array(ab, pa.int64()), c=pa.array(c, pa.int64()))
        self.entry = dict(zip(self.rank.values(), self.rank))
        #: bytes as the characters of the same numbers, as DuckDB concatenates strings only
        entries = [self.entry.get(i, b"").decode("latin-1") for i in range(max(self.entry) + 1)]
        self._table("vocabulary", entries=pa.array([entries], pa.list_(pa.string())))
        self.db.execute("CREATE TABLE unsafe AS SELECT x.c FROM merges x JOIN merges y ON (y.ab >> 32) = x.c AND y.c < x.c UNION SELECT x.c FROM merges x JOIN merges y ON (y.ab & 4294967295) = x.c AND y.c < x.c")
        self.byte = np.array([self.rank[bytes([i])] for i in range(256)], np.int64)
        self.values, self.ids, self.apart = Memo(), Memo(), {}

    def _table(self, name: str, **columns: pa.Array) -> None:
        data = pa.table(columns)
        self.db.register("incoming", data)
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def _contract(self, texts: list[bytes]) -> list[np.ndarray]:
        """ids of each text by the recursive queries."""
        out: list = [np.zeros(0, "<u4")] * len(texts)
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        at = 0
        while at < len(order):
            part, work = [], 0
            while at < len(order) and (not part or work + len(texts[order[at]]) ** 2 <= WORK):
                if part and (len(texts[part[0]]) > WIDE) != (len(texts[order[at]]) > WIDE):
                    break
                part.append(order[at])
                work += len(texts[order[at]]) ** 2
                at += 1
            lens = np.array([len(texts[i]) for i in part])
            raw = np.frombuffer(b"".join(texts[i] for i in part), np.uint8)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lens))), pa.int32()), pa.array(self.byte[raw]))
            self._table("start", w=pa.array(np.arange(len(part))), ids=lists)
            found = self.db.sql(STEP if lens[0] <= WIDE else STEP_LONG).to_arrow_table()
            ids = found["ids"].combine_chunks()
            bounds, flat = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<u4")
            for w, lo, hi in zip(found["w"].to_pylist(), bounds[:-1], bounds[1:]):
                out[part[w]] = flat[lo:hi]
        return out

    def _bytes(self, ids) -> bytes:
        return b"".join([self.entry[i] for i in ids.tolist()])

    def _moving(self, ids: np.ndarray, borders: np.ndarray) -> np.ndarray:
        """The borders (numbers of the tokens after them) whose two tokens don't stay as they are."""
        pairs = list(zip(ids[borders - 1].tolist(), ids[borders].tolist()))
        new = list({p for p in pairs if p not in self.apart})
        for (a, b), x in zip(new, self._contract([self.entry[a] + self.entry[b] for a, b in new])):
            self.apart[a, b] = x.tolist() == [a, b]
        moving = borders[[not self.apart[p] for p in pairs]] if pairs else borders
        if len(self.apart) > MOST:
            self.apart.clear()
        return moving

    def _long(self, piece: bytes) -> np.ndarray:
        """ids of a long piece: blocks, mended where they meet."""
        parts = self._contract([piece[i : i + LONG] for i in range(0, len(piece), LONG)])
        ids, reach = np.concatenate(parts), REACH
        borders = np.cumsum([len(x) for x in parts])[:-1]
        while len(bad := self._moving(ids, borders)):
            spans: list[list[int]] = []
            for b in bad.tolist():
                if spans and b - reach <= spans[-1][1]:
                    spans[-1][1] = min(b + reach, len(ids))
                else:
                    spans.append([max(b - reach, 0), min(b + reach, len(ids))])
            made, out, at, size, edges = self._contract([self._bytes(ids[a:z]) for a, z in spans]), [], 0, 0, []
            for (a, z), x in zip(spans, made):
                out += [ids[at:a], x]
                size += a - at
                edges += [size, size + len(x)]
                size, at = size + len(x), z
            ids, reach = np.concatenate([*out, ids[at:]]), reach * 2
            borders = np.unique([e for e in edges if 0 < e < len(ids)]).astype(np.int64)
        return ids

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Little-endian uint32 ids of each piece, by contraction for those that aren't entries."""
        out: list[bytes] = [b""] * len(pieces)
        rest = []
        for i, p in enumerate(pieces):
            r = self.rank.get(p)
            if r is not None:
                out[i] = r.to_bytes(4, "little")
            elif len(p) > LONG:
                out[i] = self._long(p).tobytes()
            else:
                rest.append(i)
        for i, x in zip(rest, self._contract([pieces[i] for i in rest])):
            out[i] = x.tobytes()
        return out

    def piece_ids(self, pieces: list[str]) -> list[bytes]:
        return self.encode_pieces([p.encode() for p in pieces])

    def piece_values(self, pieces: list[str]) -> list[tuple[bytes, str]]:
        """(ids, the same in decimal) of each piece."""
        raw = self.piece_ids(pieces)
        return [(r, " ".join(map(str, np.frombuffer(r, "<u4").tolist()))) for r in raw]

    def _cut(self, texts: list[str], memo: Memo, learn, joined) -> Iterator[list]:
        """Each text's units in order, by their values.  ``learn`` gives the values of new pieces, ``joined`` that of a unit of several."""
        parts = [CUT(t) if ODD_SPACE(t) else t.split(" ") for t in texts]
        memo.trim()
        get = memo.rest.get
        values = [[memo.first.get(p[0]), *map(get, p[1:])] for p in parts]
        new: dict[str, list[str]] = {}  # pieces of each unit that isn't known, with the space before it
        for p, v in zip(parts, values):
            if None in v:
                for i, x in enumerate(v):
                    if x is None and (u := " " + p[i] if i else p[0]) not in new:
                        new[u] = [u] if self.word(p[i]) else self.pieces(u)
        fresh = list({q for ps in new.values() for q in ps if memo.piece(q) is None})
        found = dict(zip(fresh, learn(fresh)))
        for q, x in found.items():
            memo.keep(q, x)
        made = {}
        for u, ps in new.items():
            xs = [found[q] if q in found else memo.piece(q) for q in ps]
            made[u] = xs[0] if len(xs) == 1 else joined(xs)
        for p, v in zip(parts, values):
            if None in v:
                for i, x in enumerate(v):
                    if x is None:
                        if i:
                            v[i] = memo.rest[p[i]] = made[" " + p[i]]
                        else:
                            v[i] = memo.first[p[i]] = made[p[i]]
            yield v

    def units(self, texts: list[str]) -> Iterator[list[tuple[bytes, str]]]:
        """(ids, the same in decimal) of each text's units in order."""
        return self._cut(texts, self.values, self.piece_values, lambda xs: (b"".join([x[0] for x in xs]), " ".join([x[1] for x in xs])))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """ids of each text."""
        return [np.frombuffer(b"".join(units), "<u4") for units in self._cut(texts, self.ids, self.piece_ids, b"".join)]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """Bytes of each id list."""
        lens = np.array([len(x) for x in ids], np.int64)
        flat = np.concatenate(ids).astype(np.int64) if ids else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lens))), pa.int32()), pa.array(flat))
        self.db.register("docs", pa.table({"d": pa.array(np.arange(len(ids))), "ids": lists}))
        got = self.db.execute(DECODE).fetchall()
        self.db.unregister("docs")
        out = [b""] * len(ids)
        for d, text in got:
            out[d] = (text or "").encode("latin-1")
        return out


def encode_decode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = Engine.get(ranks, pattern)
        for b in batches:
            at, _ = utf8(b.column(1))
            for i, j in steps(at, 1 << 20):
                ids, sums = [], []
                for units in engine.units([t or "" for t in b.column(1).slice(i, j - i).to_pylist()]):
                    ids.append(np.frombuffer(b"".join([u[0] for u in units]), "<u4"))
                    sums.append(hashlib.sha256(" ".join([u[1] for u in units if u[1]]).encode()).hexdigest())
                decoded = [hashlib.sha256(x).hexdigest() for x in engine.decode(ids)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array([len(x) for x in ids], pa.int64()), pa.array(sums), pa.array(decoded)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                )

    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encode_column(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``docs`` with columns ``token_ids array<int>`` and ``decoded_sha256``, the digest of what those ids decode to (added last; older ones of
    these names are replaced)."""
    from pyspark.sql import types as T

    docs = docs.drop("token_ids", "decoded_sha256")
    at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = Engine.get(ranks, pattern)
        for b in batches:
            bounds, _ = utf8(b.column(at))
            for i, j in steps(bounds, 1 << 20):
                part = b.slice(i, j - i)
                ids = engine.encode([t or "" for t in part.column(at).to_pylist()])
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))
                decoded = pa.array([hashlib.sha256(x).hexdigest() for x in engine.decode(ids)])
                yield pa.RecordBatch.from_arrays([*part.columns, lists, decoded], [*part.schema.names, "token_ids", "decoded_sha256"])

    return docs.mapInArrow(run, schema)
