import hashlib
import random
import zlib

import numpy as np
import pytest

from docmill.llm import media as M


def test_cuts_follow_content():
    rng = random.Random(1)
    raw = bytes(rng.randrange(256) for _ in range(200_000))
    ends = M.cuts(raw)
    sizes = [b - a for a, b in zip([0, *ends], ends)]
    assert ends[-1] == len(raw) and max(sizes) <= M.MOST and min(sizes[:-1]) >= M.LEAST
    h, allowed = 0, []
    for i, b in enumerate(raw[:5000]):
        h = ((h << 1) + int(M.GEAR[b])) & 0xFFFFFFFF
        if h >> (32 - M.BITS) == 0:
            allowed.append(i + 1)
    assert [c for c in M.candidates(np.frombuffer(raw, np.uint8)).tolist() if c <= 5000] == allowed
    other = b"xyz" + raw
    pieces = lambda x, e: {x[a:b] for a, b in zip([0, *e], e)}
    moved = pieces(raw, ends) & pieces(other, M.cuts(other))
    assert len(moved) > 0.9 * len(ends)


def check(rows, texts):
    by = {}
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        payload = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        value = (r.media_bytes, r.media_sha256, r.feature)
        assert by.setdefault(payload, value) == value


def test_round_trip_and_shared_chunks(spark, documents, tmp_path):
    docs = documents.select("doc_id", "text").repartition(6)
    check(M.round_trip(docs).collect(), {r.doc_id: r.text for r in documents.collect()})
    index = M.store(docs, str(tmp_path / "packs"))
    recipes = M.recipes(index).cache()
    places = {(bytes(c.digest), c.pack, c.offset) for r in recipes.collect() for c in r.chunks}
    assert len(places) == len({p[0] for p in places})
    smaller = M.compact(recipes, str(tmp_path / "packs"), str(tmp_path / "compacted"))
    assert M.features(smaller, str(tmp_path / "compacted")).drop("n_chunks").exceptAll(M.features(recipes, str(tmp_path / "packs")).drop("n_chunks")).count() == 0
    size = lambda d: sum(f.stat().st_size for f in (tmp_path / d).iterdir())
    assert size("compacted") < size("packs")


def test_damage_is_found(spark, documents, tmp_path):
    index = M.store(documents.select("doc_id", "text").limit(5), str(tmp_path / "packs"))
    for f in (tmp_path / "packs").glob("*.cdc"):
        raw = bytearray(f.read_bytes())
        raw[len(raw) // 2] ^= 255
        f.write_bytes(raw)
    with pytest.raises(Exception, match="damaged|zstd|Zstd"):
        M.features(M.recipes(index), str(tmp_path / "packs")).collect()


def test_edges(spark, edges, nothing):
    rows = M.round_trip(edges).collect()
    assert len(rows) == edges.count()
    check(rows, {r.doc_id: r.text for r in edges.collect()})
    assert M.round_trip(nothing).count() == 0
