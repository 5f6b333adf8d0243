"""Elias-Fano sequences and quantised values in flat files that are memory-mapped."""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid
from collections import OrderedDict

import numpy as np

from docmill.llm.bitpack import _open

#: Words of 64 bits that an entry of a select directory covers.
BLOCK = 4
#: Position of the r-th set bit of a byte.
_IN_BYTE = np.array([[([i for i in range(8) if b >> i & 1] + [0] * 8)[r] for r in range(8)] for b in range(256)], np.uint8)


def _select(words: np.ndarray, counts: np.ndarray, r: np.ndarray, ones: bool) -> np.ndarray:
    """Positions of the r-th (from 0) ones or zeros; ``counts`` has how many lie before each block."""
    block = np.searchsorted(counts, r, "right") - 1
    rest = (r - counts[block].astype(np.int64)).astype(np.int16)
    own = words[block[:, None] * BLOCK + np.arange(BLOCK)]
    own = own if ones else ~own
    upto = np.cumsum(np.bitwise_count(own), axis=1, dtype=np.int16)
    word = (upto <= rest[:, None]).sum(axis=1, dtype=np.int8)
    line = np.arange(len(r))
    rest = rest - np.where(word > 0, upto[line, word - 1], 0)
    octets = own[line, word].astype("<u8").view(np.uint8).reshape(-1, 8)
    upto = np.cumsum(np.bitwise_count(octets), axis=1, dtype=np.int8)
    octet = (upto <= rest[:, None]).sum(axis=1, dtype=np.int8)
    rest = rest - np.where(octet > 0, upto[line, octet - 1], 0)
    return (block * BLOCK + word) * 64 + octet.astype(np.int64) * 8 + _IN_BYTE[octets[line, octet], rest]


class EliasFano:
    """A monotone sequence: low bits packed at their width, high bits in unary with sampled counts of ones and zeros.

    Nothing is expanded in memory: values are read by selects over the mapped words."""

    PARTS = ("low", "high", "ones", "zeros", "meta")

    @staticmethod
    def encode(values: np.ndarray) -> dict[str, np.ndarray]:
        n = len(values)
        top = int(values[-1]) if n else 0
        width = min(56, max(0, (max(top, 1) // max(n, 1)).bit_length() - 1))  # what eight bytes hold, wherever it begins
        high = (values >> np.uint64(width)).astype(np.int64)
        length = n + (int(high[-1]) if n else 0) + 1
        unary = np.zeros(-(-length // (64 * BLOCK)) * 64 * BLOCK, np.uint8)
        unary[high + np.arange(n)] = 1
        words = np.packbits(unary, bitorder="little").view("<u8")
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(words).reshape(-1, BLOCK).sum(axis=1, dtype=np.int64))))
        low = [np.zeros(0, np.uint8)]
        for i in range(0, n if width else 0, 1 << 17):  # a multiple of 8 values fills whole bytes
            cells = (values[i : i + (1 << 17), None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
            low.append(np.packbits(cells.astype(np.uint8).ravel(), bitorder="little"))
        kind = np.uint32 if length < 1 << 32 else np.uint64
        return {
            "low": np.concatenate([*low, np.zeros(8, np.uint8)]), "high": words, "ones": ones[:-1].astype(kind),
            "zeros": (np.arange(len(ones) - 1) * 64 * BLOCK - ones[:-1]).astype(kind), "meta": np.array([n, width, length], np.int64),
        }

    def __init__(self, low: np.ndarray, high: np.ndarray, ones: np.ndarray, zeros: np.ndarray, meta: np.ndarray):
        self.n, self.width, length = (int(x) for x in meta)
        self.words, self.ones, self.zeros = high, ones, zeros
        self.buckets = length - self.n
        #: the eight bytes from each byte on
        self.low = np.ndarray((len(low) - 7,), "<u8", low, strides=(1,))
        self.mask = np.uint64((1 << self.width) - 1)

    def _low(self, i: np.ndarray) -> np.ndarray:
        bit = i.astype(np.int64) * self.width
        return (self.low[bit >> 3] >> (bit & 7).astype(np.uint64)) & self.mask

    def at(self, i: np.ndarray) -> np.ndarray:
        high = _select(self.words, self.ones, i, True) - i
        return (high.astype(np.uint64) << np.uint64(self.width)) | self._low(i)

    def bucket(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of the values that share each key's high bits."""
        high = np.minimum(keys >> np.uint64(self.width), np.uint64(self.buckets)).astype(np.int64)
        lo, hi = np.zeros(len(keys), np.int64), np.full(len(keys), self.n, np.int64)
        inner = np.flatnonzero((high > 0) & (high <= self.buckets))
        lo[inner] = _select(self.words, self.zeros, high[inner] - 1, False) - (high[inner] - 1)
        inner = np.flatnonzero(high < self.buckets)
        hi[inner] = _select(self.words, self.zeros, high[inner], False) - high[inner]
        return lo, hi

    def find(self, keys: np.ndarray, least: np.ndarray | None = None, most: np.ndarray | None = None) -> np.ndarray:
        """Index of each key's first occurrence, -1 where it is absent: successor search in the key's bucket, within [least, most) if given."""
        out = np.full(len(keys), -1, np.int64)
        if not self.n or not len(keys):
            return out
        lo, hi = self.bucket(keys)
        if least is not None:
            lo, hi = np.maximum(lo, least), np.minimum(hi, most)
        end, low = hi.copy(), keys & self.mask
        live = np.flatnonzero(lo < hi)
        while len(live):
            mid = (lo[live] + hi[live]) >> 1
            less = self._low(mid) < low[live]
            lo[live[less]] = mid[less] + 1
            hi[live[~less]] = mid[~less]
            live = live[lo[live] < hi[live]]
        met = np.flatnonzero(lo < end)
        met = met[self._low(lo[met]) == low[met]]
        out[met] = lo[met]
        return out


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, values of codes): up to 256 different values as they are, more in 256 bins of equal population by their means."""
    own = np.unique(x)
    if len(own) <= 256:
        return np.searchsorted(own, x).astype(np.uint8), np.append(own, np.zeros(256 - len(own)))
    edges = np.quantile(x, np.linspace(0, 1, 257)[1:-1])
    code = np.searchsorted(edges, x, "right")
    return code.astype(np.uint8), np.bincount(code, x, minlength=256) / np.maximum(np.bincount(code, minlength=256), 1)


def save(arrays: dict[str, np.ndarray], path: str) -> None:
    """One flat file: a directory of (name, dtype, length, offset) lines, then the arrays, each at a multiple of 64."""
    lines, blobs, at = [], [], 0
    for name, x in arrays.items():
        x = np.ascontiguousarray(x)
        raw = x.tobytes()
        lines.append(f"{name} {x.dtype.str} {len(x)} {at}")
        raw += b"\0" * (-len(raw) % 64)
        blobs.append(raw)
        at += len(raw)
    head = "\n".join(lines).encode()
    head = len(head).to_bytes(8, "little") + head
    fs, base = _open(path)
    fs.create_dir(os.path.dirname(base), recursive=True)
    with fs.open_output_stream(base) as f:
        f.write(head + b"\0" * (-len(head) % 64) + b"".join(blobs))


#: Mapped files of this process, the longest unused first.
_MAPPED: OrderedDict[str, dict[str, np.ndarray]] = OrderedDict()
MOST_MAPPED = 4096


def load(path: str) -> dict[str, np.ndarray]:
    """The arrays at ``path``, memory-mapped; where the path isn't local, from a copy in the task's temporary folder."""
    if path in _MAPPED:
        _MAPPED.move_to_end(path)
        return _MAPPED[path]
    fs, base = _open(path)
    if fs.type_name == "local":
        with open(base, "rb") as f:
            raw = memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    else:
        copy = os.path.join(tempfile.gettempdir(), f"mapped-{uuid.uuid4().hex}")
        with fs.open_input_stream(base) as f, open(copy, "wb") as g:
            while part := f.read(1 << 22):
                g.write(part)
        with open(copy, "rb") as f:
            raw = memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
        os.unlink(copy)  # the mapping keeps it
    n = int.from_bytes(raw[:8], "little")
    start = 8 + n + (-(8 + n) % 64)
    arrays = {}
    for line in bytes(raw[8 : 8 + n]).decode().split("\n"):
        name, kind, length, at = line.split(" ")
        arrays[name] = np.frombuffer(raw, np.dtype(kind), int(length), start + int(at))
    _MAPPED[path] = arrays
    if len(_MAPPED) > MOST_MAPPED:
        _MAPPED.popitem(last=False)
    return arrays


def sequence(arrays: dict[str, np.ndarray], name: str) -> EliasFano:
    return EliasFano(*(arrays[f"{name}.{x}"] for x in EliasFano.PARTS))


def named(name: str, values: np.ndarray) -> dict[str, np.ndarray]:
    return {f"{name}.{k}": v for k, v in EliasFano.encode(values).items()}
