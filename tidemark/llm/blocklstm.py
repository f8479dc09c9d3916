"""A bidirectional LSTM over the blocks of pages, in numpy."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

from tidemark.llm.htmlblocks import PATH_BUCKETS, Block

HIDDEN = 16
WORD_BUCKETS = 128
_PLAIN = 8
_FEATURES = WORD_BUCKETS + _PLAIN
_BLOCKS_AT_ONCE = 20_000
_ENDINGS = tuple(".!?…。！？:;\"'”»")

Weights = dict[str, np.ndarray]


@dataclass(frozen=True)
class Sequences:
    """Blocks of several pages, one after the other, as what the network reads."""

    paths: list[tuple[frozenset[int], frozenset[int]]]
    path: np.ndarray
    features: np.ndarray
    sizes: np.ndarray


def sequences(pages: list[list[Block]], words: dict[str, int]) -> Sequences:
    """``words`` remembers the buckets of words between calls."""
    numbers: dict[tuple, int] = {}
    path = np.array([numbers.setdefault(b.path, len(numbers)) for p in pages for b in p], np.int64)
    sizes = np.array([len(p) for p in pages], np.int64)
    features = np.zeros((len(path), _FEATURES), np.float32)
    split = [b.text.lower().split() for p in pages for b in p]
    counts = np.array([len(s) for s in split], np.int64)
    found = np.fromiter((_bucket(w, words) for s in split for w in s), np.int64, counts.sum())
    cells = np.repeat(np.arange(len(split)), counts) * WORD_BUCKETS + found
    hist = np.bincount(cells, minlength=len(split) * WORD_BUCKETS).reshape(-1, WORD_BUCKETS)
    if len(split):
        features[:, :WORD_BUCKETS] = hist / np.sqrt((hist**2).sum(axis=1, keepdims=True).clip(1))
        features[:, WORD_BUCKETS:] = _plain(pages, counts)
    return Sequences(list(numbers), path, features, sizes)


def _bucket(word: str, words: dict[str, int]) -> int:
    found = words.get(word)
    if found is None:
        if len(words) > 200_000:
            words.clear()
        found = words[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORD_BUCKETS
    return found


def _plain(pages: list[list[Block]], counts: np.ndarray) -> np.ndarray:
    chars = np.array([len(b.text) for p in pages for b in p])
    linked = np.array([b.linked for p in pages for b in p])
    ends = np.array([b.text.endswith(_ENDINGS) for p in pages for b in p])
    place = np.concatenate([(np.arange(len(p)) + 0.5) / max(len(p), 1) for p in pages])
    share = np.concatenate([[sum(len(b.text) for b in p)] * len(p) for p in pages])
    columns = (
        np.log1p(chars) / 5,
        np.log1p(counts) / 4,
        linked / chars,
        ends,
        place,
        chars / share,
        chars < 30,
        np.ones(len(chars)),
    )
    return np.stack(columns, axis=1)


def start(seed: int) -> Weights:
    rng = np.random.default_rng(seed)
    gates = 4 * HIDDEN
    out: Weights = {}
    for side in "fb":
        out[f"around_{side}"] = rng.standard_normal((PATH_BUCKETS, gates)) * 0.1
        out[f"own_{side}"] = rng.standard_normal((PATH_BUCKETS, gates)) * 0.1
        out[f"text_{side}"] = rng.standard_normal((_FEATURES, gates)) * 0.1
        out[f"back_{side}"] = rng.standard_normal((HIDDEN, gates)) * 0.2
        out[f"bias_{side}"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
        out[f"out_{side}"] = rng.standard_normal(HIDDEN) * 0.3
    out["out"] = np.zeros(1)
    return {k: v.astype(np.float32) for k, v in out.items()}


def _hot(paths: list, which: int) -> np.ndarray:
    hot = np.zeros((len(paths), PATH_BUCKETS), np.float32)
    for i, path in enumerate(paths):
        hot[i, list(path[which])] = 1.0
    return hot


def _entering(w: Weights, side: str, seq: Sequences, hot=None) -> np.ndarray:
    """What tag paths and texts add to the gates of every block."""
    if hot is None:
        by_path = np.stack([
            w[f"around_{side}"][list(a)].sum(axis=0) + w[f"own_{side}"][list(o)].sum(axis=0) for a, o in seq.paths
        ]) if seq.paths else np.zeros((0, 4 * HIDDEN), np.float32)
    else:
        by_path = hot[0] @ w[f"around_{side}"] + hot[1] @ w[f"own_{side}"]
    return by_path[seq.path] + seq.features @ w[f"text_{side}"] + w[f"bias_{side}"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


def probabilities(w: Weights, pages: list[list[Block]], words: dict[str, int]) -> list[np.ndarray]:
    """The probability of each block to belong to the main text; pages run side by side."""
    out: list[np.ndarray] = [np.zeros(0)] * len(pages)
    order = sorted(range(len(pages)), key=lambda i: -len(pages[i]))
    at = 0
    while at < len(order) and pages[order[at]]:
        # Pages of like length together: as many as keep the blocks at once bounded.
        many = max(1, _BLOCKS_AT_ONCE // len(pages[order[at]]))
        chosen = [i for i in order[at : at + many] if pages[i]]
        seq = sequences([pages[i] for i in chosen], words)
        logits = w["out"] + _run(w, "f", seq) + _run(w, "b", seq)
        for i, part in zip(chosen, np.split(_sigmoid(logits), np.cumsum(seq.sizes)[:-1])):
            out[i] = part
        at += many
    return out


def _run(w: Weights, side: str, seq: Sequences) -> np.ndarray:
    """One direction over pages that are sorted by falling number of blocks."""
    entering = _entering(w, side, seq)
    first = np.cumsum(seq.sizes) - seq.sizes
    step = 1 if side == "f" else -1
    begin = first if side == "f" else first + seq.sizes - 1
    h = np.zeros((len(first), HIDDEN), np.float32)
    c, out = np.zeros_like(h), np.zeros(len(entering), np.float32)
    for t in range(int(seq.sizes.max(initial=0))):
        n = int(np.searchsorted(-seq.sizes, -t, side="left"))
        rows = begin[:n] + t * step
        z = entering[rows] + h[:n] @ w[f"back_{side}"]
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        c[:n] = f * c[:n] + i * np.tanh(z[:, 3 * HIDDEN :])
        h[:n] = o * np.tanh(c[:n])
        out[rows] = h[:n] @ w[f"out_{side}"]
    return out


def loss_and_gradients(w: Weights, seq: Sequences, labels: np.ndarray) -> tuple[float, Weights]:
    """Mean cross entropy and its gradients, by going back through both directions."""
    hot = _hot(seq.paths, 0), _hot(seq.paths, 1)
    n, t_max = len(seq.sizes), int(seq.sizes.max())
    first = np.cumsum(seq.sizes) - seq.sizes
    steps = np.arange(t_max)[:, None]
    there = steps < seq.sizes
    traces, logits = {}, np.full(len(labels), w["out"][0], np.float32)
    for side in "fb":
        rows = first + steps if side == "f" else first + seq.sizes - 1 - steps
        rows = np.where(there, rows, 0)
        entering = _entering(w, side, seq, hot)
        h = np.zeros((t_max + 1, n, HIDDEN), np.float32)
        c = np.zeros_like(h)
        gates = np.zeros((t_max, n, 4 * HIDDEN), np.float32)
        for t in range(t_max):
            z = entering[rows[t]] + h[t] @ w[f"back_{side}"]
            z[:, : 3 * HIDDEN] = _sigmoid(z[:, : 3 * HIDDEN])
            z[:, 3 * HIDDEN :] = np.tanh(z[:, 3 * HIDDEN :])
            i, f, o, g = np.split(z, 4, axis=1)
            on = there[t][:, None]
            c[t + 1] = np.where(on, f * c[t] + i * g, c[t])
            h[t + 1] = np.where(on, o * np.tanh(c[t + 1]), h[t])
            gates[t] = z
        traces[side] = rows, h, c, gates
        logits[rows[there]] += (h[1:] @ w[f"out_{side}"])[there]
    p = _sigmoid(logits)
    loss = -np.mean(np.where(labels, np.log(p + 1e-7), np.log(1 - p + 1e-7)))
    d_logit = ((p - labels) / len(labels)).astype(np.float32)
    grads: Weights = {"out": d_logit.sum(keepdims=True)}
    for side in "fb":
        rows, h, c, gates = traces[side]
        back, out = w[f"back_{side}"], w[f"out_{side}"]
        given = np.where(there, d_logit[rows], 0)
        grads[f"out_{side}"] = np.einsum("tn,tnh->h", given, h[1:])
        d_h, d_c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        d_z = np.zeros_like(gates)
        for t in reversed(range(t_max)):
            i, f, o, g = np.split(gates[t], 4, axis=1)
            on = there[t][:, None]
            full_h = d_h + given[t][:, None] * out
            tanh_c = np.tanh(c[t + 1])
            full_c = d_c + full_h * o * (1 - tanh_c**2)
            z = np.hstack([
                full_c * g * i * (1 - i), full_c * c[t] * f * (1 - f), full_h * tanh_c * o * (1 - o), full_c * i * (1 - g**2),
            ])
            d_z[t] = np.where(on, z, 0)
            d_h = np.where(on, d_z[t] @ back.T, d_h)
            d_c = np.where(on, full_c * f, d_c)
        grads[f"back_{side}"] = np.einsum("tnh,tnz->hz", h[:-1], d_z)
        by_block = np.zeros((len(labels), 4 * HIDDEN), np.float32)
        by_block[rows[there]] = d_z[there]
        grads[f"bias_{side}"] = by_block.sum(axis=0)
        grads[f"text_{side}"] = seq.features.T @ by_block
        by_path = np.zeros((len(seq.paths), 4 * HIDDEN), np.float32)
        np.add.at(by_path, seq.path, by_block)
        grads[f"around_{side}"] = hot[0].T @ by_path
        grads[f"own_{side}"] = hot[1].T @ by_path
    return float(loss), grads


def trained(pages: list[list[Block]], labels: list[list[bool]], seed: int, epochs: int, batch: int = 24) -> Weights:
    """Weights fitted by Adam. Words of tag paths are dropped at random, so that context counts."""
    rng, w, words = np.random.default_rng(seed), start(seed), {}
    pages, labels = zip(*[(p, x) for p, x in zip(pages, labels) if p])
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    step, total = 0, epochs * -(-len(pages) // batch)
    for _ in range(epochs):
        # Pages of like length together, in random order of groups.
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]) * rng.uniform(0.8, 1.25))
        groups = [order[i : i + batch] for i in range(0, len(order), batch)]
        for g in rng.permutation(len(groups)):
            some = [_dropped(pages[i], rng) for i in groups[g]]
            seq = sequences(some, words)
            gold = np.array([y for i in groups[g] for y in labels[i]], np.float32)
            _, grads = loss_and_gradients(w, seq, gold)
            size = np.sqrt(sum(float((v**2).sum()) for v in grads.values()))
            step += 1
            rate = 0.02 * (1 - (step - 1) / total) + 0.0005
            for k, v in grads.items():
                v = v / max(1.0, size)
                first[k] += 0.1 * (v - first[k])
                second[k] += 0.01 * (v * v - second[k])
                w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
    return w


def _dropped(page: list[Block], rng) -> list[Block]:
    """The page with a few words of its tag paths unseen, the same ones in every block."""
    words = sorted(frozenset().union(*[a | o for a, o in (b.path for b in page)]))
    lost = frozenset(w for w, r in zip(words, rng.random(len(words))) if r < 0.08)
    return [Block(b.text, (b.path[0] - lost, b.path[1] - lost), b.linked) for b in page] if lost else page
