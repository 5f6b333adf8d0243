"""Memoised encoding of text by space-delimited units with the tokenizers library.

In the byte-level pattern a space always begins a new piece when a non-space follows, so a text may be cut before each such space and its
units encoded apart.  Texts that hold an added token's literal (as ``<|endoftext|>``), which the library gives that token's id, are encoded whole.
Units repeat; a process keeps the ids of those it has met, about ``MOST`` of them, and a text's new units without a space of their own
go to the library in one call.
"""

from __future__ import annotations

import os
import re

import numpy as np

MOST = 1_000_000
#: A space that begins no piece for sure, and the cut before those that do.
ODD_SPACE, CUT = re.compile(r" (?!\S)").search, re.compile(r" (?=\S)").split


class UnitIds:
    """ids of a text as the tokenizers library gives them."""

    _one: dict[str, "UnitIds"] = {}

    @classmethod
    def get(cls, path: str) -> "UnitIds":
        if path not in cls._one:
            cls._one[path] = cls(path)
        return cls._one[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.size = size = self.tokenizer.get_vocab_size()
        self.spaced = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        self.first: dict[str, bytes] = {}
        self.rest: dict[str, bytes] = {}

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn(self, units: list[str]) -> list[bytes]:
        """ids of new units that hold no space, the space before each included: one call on all of them, cut where tokens begin with that space."""
        if not units:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast(["".join([" " + u for u in units])], add_special_tokens=False)[0].ids, "<u4")
        bounds = np.flatnonzero(self.spaced[ids]).tolist()
        if len(bounds) != len(units):
            raise ValueError("a unit's tokens don't begin with its space")
        raw = ids.tobytes()
        found = [raw[4 * a : 4 * z] for a, z in zip(bounds, [*bounds[1:], len(ids)])]
        self.rest.update(zip(units, found))
        return found

    def text(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if any(t in text for t in self.added):
            return self._whole(text)
        head, *units = CUT(text) if ODD_SPACE(text) else text.split(" ")
        for memo, most in ((self.rest, MOST), (self.first, MOST // 10)):
            if len(memo) > most:
                memo.clear()
        if head not in self.first:
            self.first[head] = self._whole(head).tobytes()
        values = list(map(self.rest.get, units))
        if None in values:
            at = [i for i, x in enumerate(values) if x is None]
            new = {units[i] for i in at}
            known = {u: self._whole(" " + u).tobytes() for u in new if " " in u}
            self.rest.update(known)
            plain = [u for u in new if u not in known]
            known |= zip(plain, self._learn(plain))
            for i in at:
                values[i] = known[units[i]]
        return np.frombuffer(self.first[head] + b"".join(values), "<u4")
