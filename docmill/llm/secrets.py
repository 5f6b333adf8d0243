"""Secret scanning by dictionary-primed zstandard novelty.

Base findings come from fixed patterns.  Beyond them, a string of ``LEAST`` or more characters of a credential's alphabet that
begins within ``REACH`` characters after a sensitive word, on its line or a later one, is a candidate; so is one that a line break alone
parts from a novel string, as in a key of several lines.  A compressor primed with a
dictionary of common identifiers and the candidate's own surroundings (``AROUND`` characters on each side, the
candidate cut out) measures its marginal bytes: what it adds to the compressed size of nothing.  A candidate whose marginal
bytes reach ``NOVELTY`` of those of a random string of its alphabet and length (or of its length, if that is less) is incompressible there and is reported as ``novel``; repeated identifiers, words
and paths compress away.  Candidates that a base finding overlaps are not reported again.

Defined results: a null text is empty and has no findings; each row is its own result; ``base_sha256`` of no findings is
the SHA-256 of the empty string and ``spans`` is then empty; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "novel")
LEAST, REACH, AROUND, NOVELTY = 16, 40, 400, 0.75
SENSITIVE = ("password", "passwd", "secret", "token", "apikey", "api_key", "api-key", "credential", "bearer", "authorization", "private", "access_key", "accesskey", "signature")

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
#: Runs of under 24 characters fail, so only longer runs need be found.
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
BREAK = re.compile(r"[\x20\t]{0,80}\r?\n[\x20\t]{0,80}")
#: From narrow to wide; the first that holds a candidate's letters and digits is its alphabet, beside the other characters that it has.
ALPHABETS = (
    string.digits, "0123456789abcdef", "0123456789ABCDEF", string.ascii_lowercase, string.ascii_uppercase, string.ascii_uppercase + "234567", string.ascii_lowercase + "234567",
    string.digits + string.ascii_lowercase, string.digits + string.ascii_uppercase, string.ascii_letters, string.digits + string.ascii_letters,
)
WORDS = re.compile("|".join(map(re.escape, SENSITIVE)))

IDENTIFIERS = (
    "import from class def return self public private static final void string int long double boolean true false null none "
    "const var let function require module export async await config settings environment variable export default header "
    "authorization bearer basic token secret password passwd api_key apikey access_key client_id client_secret username user "
    "http https www com org net localhost example test staging production database host port url path file name value "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0000000000000000 xxxxxxxxxxxxxxxx your-key-here changeme placeholder"
).encode()


def marginal_bytes(candidate: str, around: str) -> int:
    """Compressed bytes that ``candidate`` adds after the identifiers and ``around``."""
    primed = zstandard.ZstdCompressionDict(IDENTIFIERS + b"\n" + around.encode("utf-8", "replace"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    press = zstandard.ZstdCompressor(level=3, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False).compress
    return len(press(candidate.encode())) - len(press(b""))


def alphabet(candidate: str) -> str:
    used = set(candidate)
    other = "".join(sorted(used & set("+/_=-")))
    return next(a for a in ALPHABETS if used <= set(a + other)) + other


@lru_cache(4096)
def random_bytes(letters: str, length: int) -> int:
    """Marginal bytes of a random string of these letters."""
    return marginal_bytes("".join(random.Random(length).choices(letters, k=length)), "")


def is_novel(candidate: str, around: str) -> bool:
    n = len(candidate)
    return marginal_bytes(candidate, around) >= NOVELTY * min(n, random_bytes(alphabet(candidate), n))


def base_spans(text: str, lowered: str) -> list[tuple[int, int, str]]:
    out = []
    if any(w in lowered for w in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    return out + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


class Covered:
    """Whether any of the spans meets a range, by bisection."""

    def __init__(self, spans: list[tuple[int, int, str]]):
        spans = sorted(spans)
        self.starts, self.ends = [s[0] for s in spans], list(accumulate((s[1] for s in spans), max))

    def __call__(self, a: int, b: int) -> bool:
        i = bisect_left(self.starts, b)  # those before it begin under b, and the furthest of them ends at ends[i - 1]
        return i > 0 and self.ends[i - 1] > a


def novel_spans(text: str, lowered: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    if len(lowered) != len(text):  # a letter whose lower case is longer: positions must hold
        lowered = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    out, done, covered, run_end = [], 0, Covered(base), 0

    def following(at: int, end: int) -> tuple[int, int] | None:
        """The first candidate from ``at`` that begins by ``end``: no more than REACH characters are searched, and a run is
        walked to its end once."""
        nonlocal run_end
        found = CANDIDATE.search(text, at, end + LEAST)
        if found is None:
            return None
        if found.end() > run_end:
            run_end = CANDIDATE.match(text, found.start()).end()
        return found.start(), run_end

    for w in WORDS.finditer(lowered):
        at, end = max(w.end(), done), w.end() + REACH
        while at <= end and (span := following(at, end)):
            start, at = span
            if covered(start, at):
                continue
            done = at
            around = text[max(0, start - AROUND) : start] + "\n" + text[at : at + AROUND]
            if is_novel(text[start:at], around):
                out.append((start, at, "novel"))
                if new_line := BREAK.match(text, at):
                    end = max(end, new_line.end())
    return out


def scan_text(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base, all) spans (start, end, kind) in code points, by start and then kind."""
    lowered = text.lower()
    base = base_spans(text, lowered)
    spans = [*base, *(novel_spans(text, lowered, base) if any(w in lowered for w in SENSITIVE) else [])]
    order = lambda s: (s[0], KINDS.index(s[2]))
    return sorted(base, key=order), sorted(spans, key=order)


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_novel) of each row."""
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts: dict[str, list[int]] = {k: [] for k in KINDS}
            sums, spans = [], []
            for text in b.column(1):
                base, every = scan_text(text.as_py() or "")
                for k in KINDS:
                    counts[k].append(sum(s[2] == k for s in every))
                sums.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(every))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(counts[k], pa.int64()) for k in ("assign", "access", "hex")), pa.array(sums, pa.string()), pa.array(spans, pa.string()), pa.array(counts["novel"], pa.int64())], names
            )

    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_novel bigint")
