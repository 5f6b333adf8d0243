"""A bidirectional LSTM in numpy that labels each leaf of a page, with its training by back-propagation through the page."""

from __future__ import annotations

import numpy as np

from docmill.llm.html_leaves import NUMBERS, PATH_BITS, WORD_BITS, Features

PATH_DIM, WORD_DIM, HIDDEN = 16, 12, 16
#: Steps of a page whose inputs are projected at once.
SPAN = 8192
#: Weight of each word of a path in its sum.
SHARE = 0.3
DIRECTIONS = ("f", "b")


def fresh(seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    width = PATH_DIM + WORD_DIM + NUMBERS

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    p = {"path": normal(1 << PATH_BITS, PATH_DIM, scale=0.1), "word": normal(1 << WORD_BITS, WORD_DIM, scale=0.1), "out": normal(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, np.float32)}
    for d in DIRECTIONS:
        p[f"x{d}"] = normal(width, 4 * HIDDEN, scale=width**-0.5)
        p[f"h{d}"] = normal(HIDDEN, 4 * HIDDEN, scale=HIDDEN**-0.5)
        p[f"c{d}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32)
    return p


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _means(table: np.ndarray, buckets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean row of each part of ``buckets``; zero for an empty part."""
    out = np.zeros((len(bounds) - 1, table.shape[1]), np.float32)
    some = np.flatnonzero(np.diff(bounds))
    for lo in range(0, len(some), SPAN):
        k = some[lo : lo + SPAN]
        a, z = bounds[k[0]], bounds[k[-1] + 1]
        out[k] = np.add.reduceat(table[buckets[a:z]], bounds[k] - a)
    return out / np.maximum(np.diff(bounds), 1)[:, None].astype(np.float32)


def inputs(p: dict[str, np.ndarray], x: Features, paths: np.ndarray | None = None) -> np.ndarray:
    """leaves x width; ``paths`` in place of the bitmaps' rows."""
    paths = x.paths if paths is None else paths
    own = paths @ p["path"] * SHARE
    return np.hstack([own[x.path], _means(p["word"], x.buckets, x.bounds), x.numbers])


def _run(z: np.ndarray, h: np.ndarray, c: np.ndarray, wh: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(outputs T x B x H, last h, last c) of projected inputs T x B x 4H."""
    H = HIDDEN
    out = np.empty((*z.shape[:2], H), np.float32)
    for t in range(len(z)):
        a = z[t] + h @ wh
        gates = _sigmoid(a[:, : 3 * H])
        g = np.tanh(a[:, 3 * H :])
        i, f, o = gates[:, :H], gates[:, H : 2 * H], gates[:, 2 * H :]
        new = f * c + i * g
        squashed = np.tanh(new)
        if keep is not None:
            keep.append((h, c, i, f, o, g, squashed))
        c, h = new, o * squashed
        out[t] = h
    return out, h, c


def _padded(x: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index T x B of each page's leaves, the same with every page turned round); short pages repeat their last."""
    t = np.arange(size.max())[:, None]
    return first + np.minimum(t, size - 1), first + np.maximum(size - 1 - t, 0)


def scores(p: dict[str, np.ndarray], x: Features) -> list[np.ndarray]:
    """Log-odds of each leaf to be main text, page by page."""
    size = np.array(x.sizes)
    first = np.cumsum(size) - size
    rows = inputs(p, x)
    out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(size)
    order = [k for k in np.argsort(size, kind="stable") if size[k]]
    i = 0
    while i < len(order):
        j = i + 1  # pages of much the same size go together
        while j < len(order) and size[order[j]] <= 1.25 * size[order[i]] + 4 and (j - i) * size[order[j]] < 1 << 14:
            j += 1
        pages = np.array(order[i:j])
        both = _padded(rows, first[pages], size[pages])
        odds = np.full(both[0].shape, p["bias"][0], np.float32)
        for d, at, w in zip(DIRECTIONS, both, (p["out"][:HIDDEN], p["out"][HIDDEN:])):
            h = c = np.zeros((len(pages), HIDDEN), np.float32)
            said = np.empty(at.shape, np.float32)
            for lo in range(0, len(at), SPAN):
                made, h, c = _run(rows[at[lo : lo + SPAN]] @ p[f"x{d}"] + p[f"c{d}"], h, c, p[f"h{d}"])
                said[lo : lo + SPAN] = made @ w
            if d == "f":
                odds += said
            else:
                back = size[pages] - 1 - np.arange(len(at))[:, None]
                odds += np.take_along_axis(said, np.maximum(back, 0), axis=0)
        for k, page in enumerate(pages):
            out[page] = odds[: size[page], k]
        i = j
    return out


def _backward(g_out: np.ndarray, keep: list, wh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gradient of the projected inputs, of the recurrent weights)."""
    gz = np.empty((*g_out.shape[:2], 4 * HIDDEN), np.float32)
    gw, gh, gc = np.zeros_like(wh), 0.0, 0.0
    for t in range(len(keep) - 1, -1, -1):
        h, c, i, f, o, g, squashed = keep[t]
        own = g_out[t] + gh
        gc = gc + own * o * (1 - squashed * squashed)
        gz[t] = np.hstack([gc * g * i * (1 - i), gc * c * f * (1 - f), own * squashed * o * (1 - o), gc * i * (1 - g * g)])
        gw += h.T @ gz[t]
        gh, gc = gz[t] @ wh.T, gc * f
    return gz, gw


def gradients(p: dict[str, np.ndarray], x: Features, labels: np.ndarray, paths: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
    """(mean logistic loss over the leaves whose label isn't negative, its gradients) of one batch of pages."""
    paths = x.paths if paths is None else paths
    size = np.array(x.sizes)
    first = np.cumsum(size) - size
    rows = inputs(p, x, paths)
    at = dict(zip(DIRECTIONS, _padded(rows, first, size)))
    valid = np.arange(size.max())[:, None] < size
    keep, made, odds = {}, {}, np.full(len(rows), p["bias"][0], np.float32)
    for d, w in zip(DIRECTIONS, (p["out"][:HIDDEN], p["out"][HIDDEN:])):
        start = np.zeros((len(size), HIDDEN), np.float32)
        keep[d] = []
        made[d], _, _ = _run(rows[at[d]] @ p[f"x{d}"] + p[f"c{d}"], start, start, p[f"h{d}"], keep[d])
        odds[at[d][valid]] += made[d][valid] @ w
    use = labels >= 0
    n = max(int(use.sum()), 1)
    chance = _sigmoid(odds)
    loss = -np.mean(np.log(np.maximum(np.where(labels == 1, chance, 1 - chance)[use], 1e-7))) if use.any() else 0.0
    g_odds = np.where(use, chance - labels, 0).astype(np.float32) / n
    g = {k: np.zeros_like(v) for k, v in p.items()}
    g["bias"][0] = g_odds.sum()
    g_rows = np.zeros_like(rows)
    for k, d in enumerate(DIRECTIONS):
        w = p["out"][k * HIDDEN : (k + 1) * HIDDEN]
        own = np.where(valid, g_odds[at[d]], 0)
        g["out"][k * HIDDEN : (k + 1) * HIDDEN] = np.tensordot(own, made[d], 2)
        gz, g[f"h{d}"] = _backward(own[:, :, None] * w, keep[d], p[f"h{d}"])
        gz *= valid[:, :, None]
        g[f"x{d}"] = np.tensordot(rows[at[d]], gz, axes=((0, 1), (0, 1)))
        g[f"c{d}"] = gz.sum(axis=(0, 1))
        g_rows[at[d][valid]] += (gz @ p[f"x{d}"].T)[valid]
    by_path = np.zeros((len(paths), PATH_DIM), np.float32)
    np.add.at(by_path, x.path, g_rows[:, :PATH_DIM])
    g["path"] = paths.T @ by_path * SHARE
    n_words = np.diff(x.bounds)
    np.add.at(g["word"], x.buckets, np.repeat(g_rows[:, PATH_DIM : PATH_DIM + WORD_DIM] / np.maximum(n_words, 1)[:, None].astype(np.float32), n_words, axis=0))
    return float(loss), g


def fit(batches: list[tuple[Features, np.ndarray]], rounds: int, seed: int = 11, rate: float = 0.02, hide: float = 0.05) -> dict[str, np.ndarray]:
    """Adam over the batches, ``rounds`` times; of each path a share of ``hide`` of its words is left out, a new one each time, so that no single name
    decides alone."""
    p, rng = fresh(seed), np.random.default_rng(seed)
    mean, square = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step, total = 0, rounds * len(batches)
    for _ in range(rounds):
        for b in rng.permutation(len(batches)):
            x, labels = batches[b]
            step += 1
            seen = x.paths * (rng.random(x.paths.shape, np.float32) >= hide)
            _, g = gradients(p, x, labels, seen)
            own = rate * (1 - step / (total + 1))
            for k, v in g.items():
                mean[k] += 0.1 * (v - mean[k])
                square[k] += 0.01 * (v * v - square[k])
                p[k] -= own * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return p
