"""Vectorised word shingles over Arrow text.

A word is a maximal run of ASCII letters, digits, ``_`` and any non-ASCII characters of the lower-cased text.  A
document's shingles are the distinct 64-bit hashes of every ``width`` consecutive words; one with fewer words has a
single shingle of all its words, and one without words has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from docmill.llm.common import STEP_BYTES, steps, utf8

WIDTH = 5
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 1 << 64)
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), 95, *range(128, 256)]] = True
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; returns a new array."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        m = max(n, STEP_BYTES + 1)
        for key, base in (("up", _P), ("down", _PINV)):
            a = np.full(m, base, np.uint64)
            a[0] = 1
            _POWERS[key] = np.multiply.accumulate(a)
    up, down = _POWERS["up"][:n], _POWERS["down"][:n]
    if n > 8 * STEP_BYTES:
        _POWERS.clear()  # a rare giant document must not pin its tables
    return up, down


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of words before each document's start) for documents at ``at`` in ``data``."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    inside = _WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = at[(at > 0) & (at < n)]
    first[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[cut - 1] = inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    up, down = _powers(n)
    total = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up)
    before = total[starts - 1]
    before[starts == 0] = 0
    hashes = mix((total[ends] - before) * down[starts])
    return hashes, np.searchsorted(starts, at)


def hashed(texts: pa.Array, width: int = WIDTH):
    """Yield (first row, rows, bounds, hashes): ``hashes[bounds[k]:bounds[k+1]]`` are row ``first+k``'s shingles in
    text order, repeats included."""
    at, data = utf8(pc.utf8_lower(texts.fill_null("")))
    for i, j in steps(at):
        lo, hi = at[i], at[j]
        words, k = _words(data[lo:hi], at[i : j + 1] - lo)
        count = np.diff(k)
        full = np.maximum(len(words) - width + 1, 0)
        rolled = np.zeros(full, np.uint64)
        for d in range(width):
            rolled += words[d : d + full] * np.uint64(pow(0xD6E8FEB86659FD93, d + 1, 1 << 64))
        rolled = mix(rolled)
        own = np.where(count >= width, count - width + 1, (count > 0).astype(np.int64))
        bounds = np.concatenate(([0], np.cumsum(own)))
        out = np.empty(bounds[-1], np.uint64)
        long = count >= width
        rows = np.repeat(np.arange(j - i), np.where(long, own, 0))
        place = np.arange(len(rows)) - np.repeat(np.cumsum(np.where(long, own, 0)) - np.where(long, own, 0), np.where(long, own, 0))
        out[bounds[rows] + place] = rolled[k[rows] + place]
        for r in np.flatnonzero((count > 0) & ~long):
            few = words[k[r] : k[r + 1]]
            x = np.array([len(few)], np.uint64)
            for w in few:
                x = mix(x * np.uint64(0xD6E8FEB86659FD93) + w)
            out[bounds[r]] = x[0]
        yield i, j - i, bounds, out
    del at, data
    pa.default_memory_pool().release_unused()  # workers live on: what a batch took goes back
