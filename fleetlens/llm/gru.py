"""Bidirectional gated recurrent network with attention pooling, forward and backward in numpy.

Texts are sequences of words. The input of a step is the vector of the word (learned for
frequent words, zero for others) beside the mean vector of its hashed character 3-grams. One
network pass reads windows of WINDOW words in both directions; attention weights over the
states pool them into one logit a window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from fleetlens.llm.common import BYTE_VALUES, POWERS, mix64

WINDOW, STRIDE = 24, 12
WORD_DIMS, GRAM_DIMS, HIDDEN, ATTENTION = 16, 12, 10, 10
GRAMS = 1 << 12
#: Windows that are in memory at once, character 3-grams at once.
CHUNK, GRAM_CHUNK = 2048, 1 << 20

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_VALUES = np.where(_WORD, BYTE_VALUES, np.uint64(0))


@dataclass
class Words:
    """Words (runs of letters, digits and bytes above 127; A-Z lower-cased) of a buffer of texts."""

    distinct: np.ndarray  # 64-bit hashes, ascending
    place: np.ndarray  # of each word among the distinct ones
    before: np.ndarray  # words before each text; one more than texts
    codes: np.ndarray  # character 3-grams of the distinct words, one after the other
    sizes: np.ndarray  # 3-grams of each distinct word, at least one
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray


def words_in(data: np.ndarray, offsets: np.ndarray) -> Words:
    data = _FOLD[data]
    word = _WORD[data]
    begins, closes = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    closes[:-1] &= ~word[1:]
    some = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][some], offsets[1:][some] - 1
    begins[first], closes[last] = word[first], word[last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    before = np.searchsorted(starts, offsets)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, before, none, none, starts, ends)
    up, down = POWERS.get(len(data) + 1)
    hashes = mix64(np.add.reduceat(_VALUES[data] * up[: len(data)], starts) * down[starts])
    distinct, one, place = np.unique(hashes, return_index=True, return_inverse=True)
    # each distinct word between two marks (bytes 1 and 2): as many 3-grams as bytes
    sizes = (ends - starts)[one]
    long = np.repeat(np.arange(len(sizes)), sizes + 2)
    j = np.arange(len(long)) - np.repeat(np.cumsum(sizes + 2) - sizes - 2, sizes + 2)
    own = data[np.clip(starts[one][long] + j - 1, 0, len(data) - 1)].astype(np.uint64)
    own[j == 0] = 1
    own[j == sizes[long] + 1] = 2
    grams = own[:-2] | own[1:-1] << np.uint64(8) | own[2:] << np.uint64(16)
    codes = (mix64(grams[j[:-2] < sizes[long[:-2]]]) % np.uint64(GRAMS)).astype(np.int64)
    return Words(distinct, place, before, codes, sizes, starts, ends)


def windows_of(before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of every window: starts STRIDE apart, the last one ends with its text.
    A text without words has none."""
    n = np.diff(before)
    count = np.where(n > WINDOW, -(-(n - WINDOW) // STRIDE) + 1, (n > 0).astype(np.int64))
    text = np.repeat(np.arange(len(n)), count)
    step = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    first = np.minimum(step * STRIDE, np.maximum(n - WINDOW, 0)[text]) + before[:-1][text]
    return text, first, np.minimum(n, WINDOW)[text]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters by name, and the hashes of the words that have a vector (ascending; row 0 is unknown)."""

    def __init__(self, vocabulary: np.ndarray, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        dims = WORD_DIMS + GRAM_DIMS

        def normal(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.vocabulary = vocabulary
        self.p: dict[str, np.ndarray] = {
            "words": np.zeros((len(vocabulary) + 1, WORD_DIMS), np.float32),
            "grams": (rng.standard_normal((GRAMS, GRAM_DIMS)) * 0.1).astype(np.float32),
            "attention": normal(2 * HIDDEN, ATTENTION), "attention_bias": np.zeros(ATTENTION, np.float32), "query": normal(ATTENTION),
            "out": normal(2 * HIDDEN), "out_bias": np.zeros(1, np.float32),
        }
        self.p["words"][1:] = rng.standard_normal((len(vocabulary), WORD_DIMS)) * 0.1
        for way in ("ahead", "back"):
            self.p[f"{way}_in"], self.p[f"{way}_state"] = normal(dims, 3 * HIDDEN), normal(HIDDEN, 3 * HIDDEN)
            self.p[f"{way}_bias"] = np.zeros(3 * HIDDEN, np.float32)

    def rows(self, distinct: np.ndarray) -> np.ndarray:
        """Row of each word in the table of word vectors."""
        if not len(self.vocabulary):
            return np.zeros(len(distinct), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, distinct), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == distinct, at + 1, 0)

    def inputs(self, distinct: np.ndarray, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Input vector of each distinct word."""
        mean = np.zeros((len(distinct), GRAM_DIMS), np.float32)
        word = np.repeat(np.arange(len(sizes)), sizes)
        for a in range(0, len(codes), GRAM_CHUNK):
            own = word[a : a + GRAM_CHUNK]
            edge = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            mean[own[edge]] += np.add.reduceat(self.p["grams"][codes[a : a + GRAM_CHUNK]], edge)
        return np.concatenate([self.p["words"][self.rows(distinct)], mean / np.maximum(sizes, 1)[:, None].astype(np.float32)], axis=1)

    def _read(self, way: str, inputs: np.ndarray, ids: np.ndarray, mask: np.ndarray, states: np.ndarray, kept: list | None) -> None:
        """States of one direction, written into ``states`` (steps x windows x HIDDEN)."""
        given = inputs @ self.p[f"{way}_in"] + self.p[f"{way}_bias"]
        weights = self.p[f"{way}_state"]
        h = np.zeros((ids.shape[1], HIDDEN), np.float32)
        whole = bool(mask.all())
        for t in range(len(ids)) if way == "ahead" else range(len(ids) - 1, -1, -1):
            x, s = given[ids[t]], h @ weights
            gates = _sigmoid(x[:, : 2 * HIDDEN] + s[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            n = np.tanh(x[:, 2 * HIDDEN :] + r * s[:, 2 * HIDDEN :])
            new = n + z * (h - n)
            if not whole:
                new = np.where(mask[t][:, None], new, h)
            if kept is not None:
                kept.append((t, h, z, r, n, s[:, 2 * HIDDEN :]))
            h = new
            states[t] = h

    def forward(self, inputs: np.ndarray, ids: np.ndarray, mask: np.ndarray, kept: dict | None = None) -> np.ndarray:
        """Logit of each window; ids and mask are steps x windows."""
        states = np.empty((*ids.shape, 2 * HIDDEN), np.float32)
        for i, way in enumerate(("ahead", "back")):
            steps = None if kept is None else kept.setdefault(way, [])
            self._read(way, inputs, ids, mask, states[:, :, i * HIDDEN : (i + 1) * HIDDEN], steps)
        u = np.tanh(states @ self.p["attention"] + self.p["attention_bias"])
        e = np.where(mask, u @ self.p["query"], np.float32(-1e30))
        e = np.exp(e - e.max(0))
        alpha = e / e.sum(0)
        pooled = (alpha[:, :, None] * states).sum(0)
        if kept is not None:
            kept |= {"states": states, "u": u, "alpha": alpha, "pooled": pooled}
        return pooled @ self.p["out"] + self.p["out_bias"][0]

    def backward(self, words: tuple[np.ndarray, np.ndarray, np.ndarray], inputs: np.ndarray, ids: np.ndarray, mask: np.ndarray, kept: dict, slope: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of every parameter; ``slope`` is the loss's derivative by each logit."""
        p, g = self.p, {}
        states, u, alpha = kept["states"], kept["u"], kept["alpha"]
        g["out"], g["out_bias"] = kept["pooled"].T @ slope, np.array([slope.sum()], np.float32)
        pooled = slope[:, None] * p["out"]
        by_alpha = (states * pooled).sum(2)
        by_score = alpha * (by_alpha - (alpha * by_alpha).sum(0))
        by_u = by_score[:, :, None] * p["query"] * (1 - u * u)
        g["query"] = (u * by_score[:, :, None]).sum((0, 1))
        g["attention"] = np.tensordot(states, by_u, ((0, 1), (0, 1)))
        g["attention_bias"] = by_u.sum((0, 1))
        by_states = alpha[:, :, None] * pooled + by_u @ p["attention"].T
        flat = ids.ravel()
        order = np.argsort(flat, kind="stable")
        edge = np.flatnonzero(np.concatenate([[True], np.diff(flat[order]) != 0]))
        by_input = np.zeros_like(inputs)
        for i, way in enumerate(("ahead", "back")):
            weights = p[f"{way}_state"]
            by_given = np.empty((*ids.shape, 3 * HIDDEN), np.float32)
            by_weights, ahead = np.zeros_like(weights), np.zeros((ids.shape[1], HIDDEN), np.float32)
            for t, h, z, r, n, s in reversed(kept[way]):
                m = mask[t][:, None].astype(np.float32)
                whole = by_states[t, :, i * HIDDEN : (i + 1) * HIDDEN] + ahead
                new = whole * m
                by_n = new * (1 - z) * (1 - n * n)
                by_z = new * (h - n) * z * (1 - z)
                by_r = by_n * s * r * (1 - r)
                by_given[t] = np.concatenate([by_z, by_r, by_n], 1)
                by_s = np.concatenate([by_z, by_r, by_n * r], 1)
                by_weights += h.T @ by_s
                ahead = whole * (1 - m) + new * z + by_s @ weights.T
            total = np.zeros((len(inputs), 3 * HIDDEN), np.float32)
            total[flat[order][edge]] = np.add.reduceat(by_given.reshape(-1, 3 * HIDDEN)[order], edge)
            g[f"{way}_state"], g[f"{way}_bias"] = by_weights, total.sum(0)
            g[f"{way}_in"] = inputs.T @ total
            by_input += total @ p[f"{way}_in"].T
        distinct, codes, sizes = words
        row = self.rows(distinct)
        g["words"] = np.zeros_like(p["words"])
        g["words"][row[row > 0]] = by_input[row > 0, :WORD_DIMS]
        by_gram = np.repeat(by_input[:, WORD_DIMS:] / np.maximum(sizes, 1)[:, None], sizes, axis=0)
        g["grams"] = np.stack([np.bincount(codes, by_gram[:, k], GRAMS) for k in range(GRAM_DIMS)], 1).astype(np.float32)
        return g

    def logits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(text, logit) of every overlapping window of a buffer of texts."""
        text, first, n = windows_of(words.before)
        inputs = self.inputs(words.distinct, words.codes, words.sizes)
        out = np.empty(len(text), np.float32)
        for a in range(0, len(text), CHUNK):
            ids, mask = steps_of(words.place, first[a : a + CHUNK], n[a : a + CHUNK])
            out[a : a + CHUNK] = self.forward(inputs, ids, mask)
        return text, out


def steps_of(place: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, whether there is one) of each step of each window: steps x windows."""
    step = np.arange(min(WINDOW, int(n.max(initial=1))))[:, None]
    mask = step < n
    return place[np.minimum(first + step, len(place) - 1)], mask


class Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float, decay: float = 1e-5) -> None:
        self.p, self.rate, self.decay, self.t = p, rate, decay, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, x in g.items():
            x = x + self.decay * self.p[k]
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.01 * (x * x - self.v[k])
            self.p[k] -= self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-7)
