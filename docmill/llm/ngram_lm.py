"""N-gram language model in an Elias-Fano trie.

Tokens are runs of non-space bytes of the text with A-Z lower-cased, and one end token a document.  A token is known by a digest of 95
bits, so what is counted and shuffled are numbers.

1. Spark counts the tokens of all training documents; range partitions of the digests become shards of the vocabulary, in which every
   counted token has its number, and the digests are an Elias-Fano sequence.
2. Every document's tokens are looked up once: exact base scores come from the counts, and the numbers are written to shared storage.
3. Level by level, tasks tally the n-grams of all training documents as sorted keys (context number, token number), compressed by the level's
   shard; a task for each shard adds them up and lays out its part of the trie.  Shards are ranges of keys with about ``SHARD`` occurrences, cut
   within a context where that alone has more, so no context gathers in one task.  N-grams of ``LEAST`` occurrences are kept, at
   any input size, and longer ones are counted only where their first part was kept (a longer n-gram can't be more frequent than it).

A shard of a level holds, for its range of contexts,

* monotone pointers in Elias-Fano code: each context's first child, so two neighbours bound its children;
* successors in Elias-Fano code, as context number in the shard x vocabulary + token: within a context they ascend, and a successor
  search between the context's pointers finds a child;
* discounted probabilities (c - ``DISCOUNT``) / c(context), and each context's share left for shorter ones, quantised to 256 values.

Files are memory-mapped from ``spark.checkpoint.dir`` (from a copy where that is no local folder); selects and searches run on the
mapped bits, and nothing is expanded.  Only one row a shard goes to the driver.

Smoothing interpolates: p(w | h) = (c(hw) - D) / c(h) for a kept n-gram, plus the context's share left x p(w | shorter h); a token by
itself has (c + 1) / (N + V + 1), an unseen one 1 / (N + V + 1).  Probabilities of all tokens and one unseen sum to one.

Defined results: a null text is empty and has its end token only; documents with null doc_id are training documents and
not held out; rows repeat as they come; without training rows N and V are 0, c is 0, and every token scores
log10(1 / 1); an empty table gives no rows; extra columns are ignored; a level holds up to 2^32 n-grams, more raise an error.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.llm.common import scratch, steps, utf8, written
from docmill.llm.elias_fano import load, named, quantised, save, sequence
from docmill.llm.shingles import mix

ORDER = 3
DISCOUNT = 0.5
LEAST = 2
#: Token occurrences of a shard of a level, types of a shard of the vocabulary, and tokens that a task sorts at once.
SHARD, TYPES, HELD = 1 << 21, 1 << 19, 1 << 21
#: Numbers of tokens that training documents don't have, and of those that they have once, which are in no kept n-gram.
UNSEEN, RARE = (1 << 32) - 1, (1 << 32) - 2
#: The end token's digest; no token has these, whose hash would take all bits.
END_H, END_CHECK = (1 << 63) - 1, (1 << 32) - 1
PART = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get(base, ((),))[0]) < n:
        up, down = (np.full(max(n, PART), x, np.uint64) for x in (base, pow(base, -1, 1 << 64)))
        up[0] = down[0] = 1
        _POWERS[base] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[base][0][:n], _POWERS[base][1][:n]


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, check, tokens before each document's start) of the words of documents at ``at`` in ``data``."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
    data = data + ((data >= 65) & (data <= 90)) * np.uint8(32)
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = at[(at > 0) & (at < n)]
    first[cut], last[cut - 1] = inside[cut], inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    wide, out = data.astype(np.uint64) + np.uint64(1), []
    for base in _BASES:
        up, down = _powers(base, n)
        total = np.cumsum(wide * up)
        before = total[starts - 1]
        before[starts == 0] = 0
        out.append(mix((total[ends] - before) * down[starts]))
    return (out[0] >> np.uint64(1)).astype(np.int64), (out[1] >> np.uint64(32)).astype(np.uint32), np.searchsorted(starts, at)


def digests(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, bounds, hashes, checks) by step: row r's tokens, its end last, lie at bounds[r]:bounds[r+1].  A long text is hashed in
    parts that end at a space."""
    at, data = utf8(texts)
    for i, j in steps(at, PART):
        lo, hi = int(at[i]), int(at[j])
        if hi - lo <= PART:
            h, check, k = _words(data[lo:hi], at[i : j + 1] - lo)
        else:
            parts, begin = [], lo
            while begin < hi:
                end = min(begin + PART, hi)
                spaces = np.flatnonzero(_SPACE[data[begin:end]])
                if end < hi and len(spaces):
                    end = begin + int(spaces[-1]) + 1
                elif end < hi:
                    after = np.flatnonzero(_SPACE[data[end:hi]])
                    end = end + int(after[0]) if len(after) else hi
                parts.append(_words(data[begin:end], np.array([0, end - begin])))
                begin = end
            h, check = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            k = np.array([0, len(h)])
        yield i, j - i, k + np.arange(j - i + 1), np.insert(h, k[1:], END_H), np.insert(check, k[1:], np.uint32(END_CHECK))


def tallied(key: np.ndarray, n: np.ndarray | None = None, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """(distinct keys in order, occurrences, values of ``more``); keys that differ in ``more`` only may stay apart."""
    by = np.argsort(key, kind="stable")
    key, more = key[by], [x[by] for x in more]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    for x in more:
        new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(key))) if n is None else np.add.reduceat(n[by], first) if len(first) else np.zeros(0, np.int64)
    return (key[first], count, *(x[first] for x in more))


def _text(docs: DataFrame, *more: F.Column) -> DataFrame:
    return docs.select(*more, F.col("text").cast("string").alias("text"))


def count_tokens(training: DataFrame) -> DataFrame:
    """(h, token, n) over all training documents, end tokens included; (h, token) is the digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            h, n, check = tallied(np.concatenate([x[0] for x in held]), None, np.concatenate([x[1] for x in held]))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(check.astype(np.int64)), pa.array(n)], ["h", "token", "n"])

        for b in batches:
            for _, _, _, h, check in digests(b.column(0)):
                held.append((h, check))
                if sum(len(x[0]) for x in held) > HELD:
                    yield flush()
        if held:
            yield flush()

    return _text(training).mapInArrow(run, "h bigint, token bigint, n bigint").groupBy("h", "token").agg(F.sum("n").alias("n"))


def cuts(n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where shards of the next level begin among contexts with ``n`` occurrences: (context, part, parts), the part by token number."""
    if not len(n):
        return (np.zeros(0, np.int64),) * 3
    total = np.cumsum(n)
    begins = np.unique(np.searchsorted(total, np.arange(0, int(total[-1]), SHARD), "right"))
    context, part, parts = [begins], [np.zeros_like(begins)], [np.ones_like(begins)]
    for c in np.flatnonzero(n > SHARD):
        k = -(-int(n[c]) // SHARD)
        context += [np.full(k, c), np.array([c + 1])]
        part += [np.arange(k), np.array([0])]
        parts += [np.full(k, k), np.array([1])]
    return tuple(np.concatenate(x).astype(np.int64) for x in (context, part, parts))


SHARD_ROW = "path string, low bigint, size bigint, total bigint, context array<bigint>, part array<bigint>, parts array<bigint>, edge array<bigint>, mass array<double>"
_NAMES = [x.split()[0] for x in SHARD_ROW.split(", ")]


def _shard_row(path: str, low: int, size: int, total: int, cut, edge=(), mass=()) -> pa.RecordBatch:
    ints, floats = pa.list_(pa.int64()), pa.list_(pa.float64())
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), ints, ints, ints, ints, floats]
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((path, low, size, total, *cut, list(edge), list(mass)), kinds)], _NAMES)


@dataclass
class Level:
    """Shards of a level in order: where they lie, the least key of each, and the number of its first n-gram."""

    paths: list[str]
    low: np.ndarray
    base: np.ndarray
    size: int
    #: least keys of the next level's shards
    bounds: np.ndarray
    #: each shard's first and last context, which others may hold, too, and the sum of its kept shares
    edge: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    mass: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @staticmethod
    def of(rows: DataFrame, universe: int | None) -> "Level":
        """From the materialised rows, one a shard."""
        got = sorted(rows.collect(), key=lambda r: r.low)
        size = np.array([r["size"] for r in got], np.int64)
        base = np.cumsum(size) - size
        total = int(size.sum())
        if total >= RARE:
            raise ValueError("a level holds more than 2^32 n-grams")
        universe = total if universe is None else universe
        bounds = [np.zeros(0, np.uint64)]
        for r, b in zip(got, base):
            context, part, parts = (np.array(x, np.uint64) for x in (r.context, r.part, r.parts))
            bounds.append(((context + np.uint64(b)) << np.uint64(32)) + part * np.uint64(universe) // np.maximum(parts, np.uint64(1)))
        edge = np.array([e for r in got for e in r.edge], np.int64)
        mass = np.array([m for r in got for m in r.mass])
        edge, place = np.unique(edge, return_inverse=True)
        mass = np.bincount(place, mass, len(edge)) if len(edge) else mass
        return Level([r.path for r in got], np.array([r.low for r in got], np.int64), base, total, np.unique(np.concatenate(bounds)), edge, mass)


def _places(level: Level, keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(shard, from, to) of ascending keys."""
    at = np.searchsorted(keys, level.low.astype(keys.dtype))
    at[:1] = 0
    at = np.append(at, len(keys))
    for s in np.flatnonzero(np.diff(at)):
        yield int(s), int(at[s]), int(at[s + 1])


def vocabulary(counts: DataFrame, folder: str) -> tuple[Level, int]:
    """(the vocabulary's shards, N): tokens are numbered in the order of their digests."""
    shards = max(1, -(-counts.count() // TYPES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()) for b in batches if b.num_rows]
        if parts:
            h, check, n = (np.concatenate(x) for x in zip(*parts))
            low, wide = int(h[0]), np.uint32 if n.max() < 1 << 32 else np.uint64
            path = f"{folder}/level1-{uuid.uuid4().hex}.eft"
            save({**named("digest", (h - low).astype(np.uint64)), "check": check.astype(np.uint32), "n": n.astype(wide)}, path)
            yield _shard_row(path, low, len(h), int(n.sum()), cuts(np.where(n >= LEAST, n, 0)))

    # A range of hashes holds about TYPES tokens, whatever the text.
    ordered = counts.select("h", "token", "n").repartitionByRange(shards, "h").sortWithinPartitions("h", "token")
    rows = written(ordered.mapInArrow(run, SHARD_ROW), "lm-level1")
    level = Level.of(rows, None)
    return level, int(rows.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0])


def numbers(level: Level, h: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, occurrences) of tokens by digest; UNSEEN and 0 for those that the vocabulary doesn't have."""
    number, count = np.full(len(h), UNSEEN, np.int64), np.zeros(len(h), np.int64)
    own, _, mark = tallied(h, None, check)
    at, met = np.full(len(own), UNSEEN, np.int64), np.zeros(len(own), np.int64)
    for s, a, z in _places(level, own):
        arrays = load(level.paths[s])
        ef, marks, n = sequence(arrays, "digest"), arrays["check"], arrays["n"]
        key = (own[a:z] - level.low[s]).astype(np.uint64)
        found = np.where(own[a:z] >= level.low[s], ef.find(key), -1)
        live = np.flatnonzero(found >= 0)
        while len(live):  # the first of equal hashes, then the next
            hit = marks[found[live]] == mark[a + live]
            ok = live[hit]
            at[a + ok], met[a + ok] = level.base[s] + found[ok], n[found[ok]]
            live = live[~hit]
            found[live] += 1
            live = live[found[live] < ef.n]
            live = live[ef.at(found[live]) == key[live]]
    # tokens of one hash and different checks may be several neighbouring entries
    place = np.searchsorted(own, h)
    while len(wrong := np.flatnonzero(mark[place] != check)):
        place[wrong] += 1
    number[:], count[:] = at[place], met[place]
    return number, count


def numbered(docs: DataFrame, level: Level, N: int, held_out: F.Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, base_score, ids) of each row, materialised; ids are little-endian uint32."""
    unit = float(np.log10(N + 1.0 * (level.size + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, n, bounds, h, check in digests(b.column(2)):
                number, count = numbers(level, h, check)
                starts = bounds[:-1]
                base = np.add.reduceat(np.log10(count + 1.0), starts) - np.diff(bounds) * unit
                raw = np.where(count == 1, RARE, number).astype("<u4").tobytes()
                ids = pa.array([raw[4 * a : 4 * z] for a, z in zip(bounds[:-1], bounds[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, n), b.column(1).slice(i, n), pa.array(np.diff(bounds)), pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)), pa.array(base), ids],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "ids"],
                )

    picked = _text(docs, F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"))
    return written(picked.mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, ids binary"), "lm-ids")


def _id_steps(ids: pa.Array, most: int = HELD) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, numbers, bounds) of rows with about ``most`` numbers in all."""
    at, data = utf8(ids)
    for i, j in steps(at, 4 * most):
        yield i, j, data[at[i] : at[j]].view("<u4").astype(np.int64), (at[i : j + 1] - at[i]) // 4


def packed_keys(key: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending keys and their counts; differences by planes of bytes, so that what is small costs little."""
    planes = [np.diff(key, prepend=np.uint64(0)).astype("<u8"), n.astype("<u4") if len(n) and n.max() < 1 << 32 else n.astype("<u8")]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes() for x in planes))


def unpacked_keys(raw: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    wide = len(data) // max(size, 1) - 8
    key = np.cumsum(np.ascontiguousarray(data[: 8 * size].reshape(8, size).T).view("<u8").ravel(), dtype=np.uint64)
    return key, np.ascontiguousarray(data[8 * size :].reshape(wide, size).T).view(f"<u{wide}").ravel().astype(np.int64)


@dataclass
class Model:
    """What tasks need: the levels' shards, N and V."""

    levels: list[Level]
    N: int
    V: int

    def children(self, k: int, context: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number, probability, the context's share left) of level k's n-grams; -1, 0 and 1 where there is none."""
        level, key = self.levels[k - 1], (context.astype(np.uint64) << np.uint64(32)) | token.astype(np.uint64)
        key, place = np.unique(key, return_inverse=True)
        number, p, left = np.full(len(key), -1, np.int64), np.zeros(len(key)), np.ones(len(key))
        bounds = self.levels[k - 2].bounds
        shard_of = {int(low): s for s, low in enumerate(level.low.tolist())}
        at = np.append(np.searchsorted(key, bounds), len(key))
        for b in np.flatnonzero(np.diff(at)):
            s, a, z = shard_of.get(int(b)), at[b], at[b + 1]
            if s is None:
                continue  # nothing was kept there
            arrays = load(level.paths[s])
            first, contexts = int(arrays["range"][0]), int(arrays["range"][1])
            own = (key[a:z] >> np.uint64(32)).astype(np.int64) - first
            inside = np.flatnonzero((own >= 0) & (own < contexts))
            if not len(inside):
                continue
            own, pointers = own[inside], sequence(arrays, "pointers")
            some, back = np.unique(own, return_inverse=True)
            ends = pointers.at(np.concatenate([some, some + 1])).astype(np.int64).reshape(2, -1)[:, back]
            left[a + inside] = arrays["leftbins"][arrays["left"][own]]
            has = np.flatnonzero(ends[0] < ends[1])
            where = inside[has]
            want = own[has].astype(np.uint64) * np.uint64(self.V) + (key[a + where] & np.uint64(0xFFFFFFFF))
            found = sequence(arrays, "successors").find(want, ends[0][has], ends[1][has])
            hit = np.flatnonzero(found >= 0)
            number[a + where[hit]], p[a + where[hit]] = level.base[s] + found[hit], arrays["pbins"][arrays["p"][found[hit]]]
        if len(level.edge):
            own = (key >> np.uint64(32)).astype(np.int64)
            e = np.minimum(np.searchsorted(level.edge, own), len(level.edge) - 1)
            split = level.edge[e] == own
            left[split] = 1 - level.mass[e[split]]
        return number[place], p[place], left[place]

    def score(self, ids: np.ndarray, bounds: np.ndarray, count_p: np.ndarray) -> np.ndarray:
        """Probability of each token given those before it in its document; ``count_p`` has them without context."""
        p, inside = count_p.copy(), np.ones(len(ids), bool)
        inside[bounds[:-1][bounds[:-1] < len(ids)]] = False
        state = np.where(ids < self.V, ids, -1)  # number of the k-gram that ends at each position
        for k in range(2, len(self.levels) + 1):
            at = np.flatnonzero(inside)
            at = at[state[at - 1] >= 0]
            # an unknown or rare token is nobody's child, yet takes the context's share
            number, own, left = self.children(k, state[at - 1], np.minimum(ids[at], self.V))
            p[at] = own + left * p[at]
            state = np.full(len(ids), -1, np.int64)
            state[at] = number
        return p


def grams(rows: DataFrame, model: Model, k: int, folder: str) -> Level:
    """Count, lay out and save level k over the materialised rows of numbers."""
    bounds, counts_of = model.levels[-1].bounds, model.levels[-1]

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            key, n = tallied(np.concatenate(held))
            held.clear()
            at = np.append(np.searchsorted(key, bounds), len(key))
            full = np.flatnonzero(np.diff(at))
            blobs = [packed_keys(key[at[s] : at[s + 1]], n[at[s] : at[s + 1]]) for s in full]
            return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int64)), pa.array(np.diff(at)[full]), pa.array(blobs, pa.binary())], ["shard", "size", "keys"])

        for b in batches:
            for _, _, ids, at in _id_steps(b.column(0)):
                state, inside = np.where(ids < model.V, ids, -1), np.ones(len(ids), bool)
                inside[at[:-1][at[:-1] < len(ids)]] = False
                for level in range(2, k + 1):
                    use = np.flatnonzero(inside)
                    use = use[(state[use - 1] >= 0) & (ids[use] < model.V)]
                    if level == k:
                        held.append((state[use - 1].astype(np.uint64) << np.uint64(32)) | ids[use].astype(np.uint64))
                    else:
                        number, _, _ = model.children(level, state[use - 1], ids[use])
                        state = np.full(len(ids), -1, np.int64)
                        state[use] = number
                if sum(map(len, held)) > HELD:
                    yield flush()
        if held:
            yield flush()

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            key, n = (np.concatenate(x) for x in zip(*held))
            key, n = tallied(key, n)
            keep = n >= LEAST
            key, n = key[keep], n[keep]
            if not len(key):
                return
            context, token = (key >> np.uint64(32)).astype(np.int64), key & np.uint64(0xFFFFFFFF)
            first, contexts = int(context[0]), int(context[-1] - context[0]) + 1
            own = context - first
            occurrences = occurrences_of(counts_of, context)
            share = (n - DISCOUNT) / occurrences
            kept = np.bincount(own, share, contexts)
            p, pbins = quantised(share)
            left, leftbins = quantised(1 - kept)
            path = f"{folder}/level{k}-{uuid.uuid4().hex}.eft"
            arrays = {"range": np.array([first, contexts]), "p": p, "pbins": pbins, "left": left, "leftbins": leftbins, "n": n.astype(np.uint32 if n.max() < 1 << 32 else np.uint64)}
            arrays |= named("pointers", np.searchsorted(own, np.arange(contexts + 1)).astype(np.uint64))
            arrays |= named("successors", own.astype(np.uint64) * np.uint64(model.V) + token)
            save(arrays, path)
            edges = sorted({first, first + contexts - 1})
            yield _shard_row(path, shard, len(key), int(n.sum()), cuts(n), edges, kept[np.array(edges) - first])

        for b in batches:
            for s, size, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if s != shard:
                    if held:
                        yield from done()
                    shard, held = s, []
                held.append(unpacked_keys(raw.as_py(), size))
        if held:
            yield from done()

    tallies = rows.where("NOT held_out").select("ids").mapInArrow(tally, "shard bigint, size bigint, keys binary")
    placed = tallies.repartition(max(1, len(bounds)), "shard").sortWithinPartitions("shard")
    return Level.of(written(placed.mapInArrow(lay, SHARD_ROW), f"lm-level{k}"), model.V)


def occurrences_of(level: Level, number: np.ndarray) -> np.ndarray:
    """Occurrences of ascending n-grams of a level by number."""
    out = np.zeros(len(number), np.int64)
    at = np.append(np.searchsorted(number, level.base), len(number))
    for s in np.flatnonzero(np.diff(at)):
        out[at[s] : at[s + 1]] = load(level.paths[s])["n"][number[at[s] : at[s + 1]] - level.base[s]]
    return out


def train(docs: DataFrame, held_out: F.Column, folder: str, order: int = ORDER) -> tuple[DataFrame, Model]:
    """(the numbered rows of all documents, the model of those that aren't held out)."""
    counts = written(count_tokens(docs.where(~held_out)), "lm-counts")
    level, N = vocabulary(counts, folder)
    rows = numbered(docs, level, N, held_out)
    model = Model([level], N, level.size)
    for k in range(2, order + 1):
        model.levels.append(grams(rows, model, k, folder))
    return rows, model


def score(rows: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each numbered row."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    N, V = model.N, model.V

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, ids, bounds in _id_steps(b.column("ids"), HELD >> 1):
                own, place = np.unique(ids, return_inverse=True)
                known = own < V
                n = np.zeros(len(own))
                n[known] = occurrences_of(model.levels[0], own[known])
                n[own == RARE] = 1
                p = model.score(ids, bounds, ((n + 1) / (N + V + 1))[place])
                total = np.add.reduceat(np.log10(p), bounds[:-1])
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*(part.column(x) for x in names[:4]), pa.array(np.full(j - i, N)), part.column("base_score"), pa.array(total)], names)

    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def model_scores(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Learn from the documents that aren't held out; score all."""
    rows, model = train(docs, held_out(), folder or scratch(docs.sparkSession, "lm"))
    return score(rows, model)
