"""A small network in numpy: bidirectional gated recurrent layers with attention pooling, over characters and words.

A word's characters run through a layer of their own, whose pooled states stand beside the word's vector; a window's
words run through a second layer, whose pooled states give the window's probability.  Inputs of both layers are rows of
tables, so a distinct word (or character) is projected once, however often it occurs.
"""

from __future__ import annotations

import numpy as np

CHARACTERS = 256
CHAR_DIM, CHAR_HIDDEN, WORD_DIM, HIDDEN, POOL = 8, 6, 8, 12, 8

Params = dict[str, np.ndarray]


def squash(x: np.ndarray) -> np.ndarray:
    """Logistic function; numpy's exponential is several times as fast as its hyperbolic tangent."""
    out = np.exp(np.minimum(-x, 80))
    out += 1
    return np.reciprocal(out, out)


def bent(x: np.ndarray) -> np.ndarray:
    """Hyperbolic tangent."""
    out = squash(2 * x)
    out *= 2
    out -= 1
    return out


def _row_sums(values: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Sums of the values that belong to each of ``count`` rows."""
    out = np.zeros((count, values.shape[1]), np.float32)
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    out[ordered[heads]] = np.add.reduceat(values[order], heads)
    return out


def new_params(words: np.ndarray, seed: int = 0) -> Params:
    """Start values; ``words`` are the words' vectors (the first row for unknown ones)."""
    rng = np.random.default_rng(seed)

    def draw(*shape: int, scale: float | None = None) -> np.ndarray:
        return rng.normal(0, scale or 1 / np.sqrt(shape[-2]), shape).astype(np.float32)

    out = {"words": words.astype(np.float32), "chars": draw(CHARACTERS, CHAR_DIM, scale=0.3)}
    for name, inputs, hidden in (("c", CHAR_DIM, CHAR_HIDDEN), ("w", WORD_DIM + 2 * CHAR_HIDDEN, HIDDEN)):
        out |= {
            f"{name}_in": draw(2, inputs, 3 * hidden), f"{name}_bias": np.zeros((2, 1, 3 * hidden), np.float32),
            f"{name}_loop": draw(2, hidden, 3 * hidden), f"{name}_key": draw(2 * hidden, POOL),
            f"{name}_ask": draw(POOL, 1)[:, 0],
        }
    return out | {"out": draw(2 * HIDDEN, 1)[:, 0], "out_bias": np.zeros(1, np.float32)}


class Layer:
    """One recurrent layer with attention pooling; ``forward`` keeps what ``backward`` needs if asked to."""

    def __init__(self, params: Params, name: str) -> None:
        self.params, self.name = params, name
        self.hidden = params[f"{name}_loop"].shape[1]

    def project(self, inputs: np.ndarray) -> np.ndarray:
        """Rows of inputs to rows of gates, for both directions: (2, rows, 3 hidden)."""
        return inputs @ self.params[f"{self.name}_in"] + self.params[f"{self.name}_bias"]

    def forward(self, gates: np.ndarray, codes: np.ndarray, sizes: np.ndarray, keep: bool = False) -> np.ndarray:
        """Pooled states of sequences: ``codes`` (n, steps) are rows of ``gates``, ``sizes`` the sequences' lengths.

        Longest first, so the sequences that have a place at a step are the first ``m``.
        """
        n, steps = codes.shape
        h, loop = self.hidden, self.params[f"{self.name}_loop"]
        order = np.argsort(-sizes, kind="stable")
        codes, sizes, row = codes[order], sizes[order], np.arange(n)
        active = n - np.searchsorted(sizes[::-1], np.arange(steps), "right")
        state, states = np.zeros((2, n, h), np.float32), np.zeros((2, n, steps, h), np.float32)
        space, kept = np.empty((2, n, 3 * h), np.float32), []
        for t, m in enumerate(active.tolist()):
            if not m:
                break
            back = sizes[:m] - 1 - t  # the other direction starts at each sequence's end
            both, before = space[:, :m], state[:, :m]
            np.take(gates[0], codes[:m, t], 0, both[0], "clip")
            np.take(gates[1], codes[row[:m], back], 0, both[1], "clip")
            looped = before @ loop
            rz = squash(both[:, :, :2 * h] + looped[:, :, :2 * h])
            r, z = rz[:, :, :h], rz[:, :, h:]
            new = bent(both[:, :, 2 * h:] + r * looped[:, :, 2 * h:])
            after = before + (1 - z) * (new - before)
            if keep:
                kept.append((m, back, looped[:, :, 2 * h:], r, z, new, before.copy()))
            state[:, :m] = after
            states[0, :m, t] = after[0]
            states[1, row[:m], back] = after[1]
        # the state at a place, in both directions, side by side
        around = np.concatenate([states[0], states[1]], 2)
        mask = np.arange(steps)[None, :] < sizes[:, None]
        keys = bent(around @ self.params[f"{self.name}_key"])
        weight = np.exp(np.clip(keys @ self.params[f"{self.name}_ask"], -30, 30)) * mask
        weight /= np.maximum(weight.sum(1, keepdims=True), 1e-9)
        pooled = np.empty((n, 2 * h), np.float32)
        pooled[order] = (weight[:, None, :] @ around)[:, 0]
        if keep:
            self.kept = (order, len(gates[0]), codes, kept, around, keys, weight)
        return pooled

    def backward(self, d_pooled: np.ndarray, grads: Params) -> np.ndarray:
        """Adds the layer's gradients; returns those of the rows of ``gates``."""
        order, rows, codes, kept, around, keys, weight = self.kept
        name, h = self.name, self.hidden
        n = len(order)
        d_pooled = d_pooled[order]
        d_weight = (around @ d_pooled[:, :, None])[:, :, 0]
        d_scores = weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))
        d_keys = d_scores[:, :, None] * self.params[f"{name}_ask"] * (1 - keys * keys)
        grads[f"{name}_ask"] += d_scores.ravel() @ keys.reshape(-1, POOL)
        grads[f"{name}_key"] += around.reshape(-1, 2 * h).T @ d_keys.reshape(-1, POOL)
        d_around = weight[:, :, None] * d_pooled[:, None, :] + d_keys @ self.params[f"{name}_key"].T
        loop, d_state, row = self.params[f"{name}_loop"], np.zeros((2, n, h), np.float32), np.arange(n)
        slopes, places = [], []
        for t in range(len(kept) - 1, -1, -1):
            m, back, inner, r, z, new, before = kept[t]
            d_after = d_state[:, :m]
            d_after[0] += d_around[:m, t, :h]
            d_after[1] += d_around[row[:m], back, h:]
            d_new = d_after * (1 - z) * (1 - new * new)
            d_z = d_after * (before - new) * z * (1 - z)
            d_r = d_new * inner * r * (1 - r)
            d_looped = np.concatenate([d_r, d_z, d_new * r], 2)
            grads[f"{name}_loop"] += before.transpose(0, 2, 1) @ d_looped
            d_state[:, :m] = d_after * z + d_looped @ loop.transpose(0, 2, 1)
            slopes.append(np.concatenate([d_r, d_z, d_new], 2))
            places.append(np.stack([codes[:m, t], codes[row[:m], back]]))
        slope, place = np.concatenate(slopes, 1), np.concatenate(places, 1)
        return np.stack([_row_sums(slope[k], place[k], rows) for k in range(2)])


class Network:
    """Probability of windows of words.  ``spelled`` (words, characters) and ``known`` (rows of ``words``) describe each
    distinct word; a window is a row of numbers of distinct words."""

    def __init__(self, params: Params) -> None:
        self.params = params
        self.chars, self.words = Layer(params, "c"), Layer(params, "w")

    def word_gates(self, spelled: np.ndarray, letters: np.ndarray, known: np.ndarray, keep: bool = False) -> np.ndarray:
        """Gate rows of distinct words."""
        gates = self.chars.project(self.params["chars"])
        self.shapes = self.chars.forward(gates, spelled, letters, keep)
        self.inputs = np.concatenate([self.params["words"][known], self.shapes], 1)
        return self.words.project(self.inputs)

    def windows(self, gates: np.ndarray, codes: np.ndarray, sizes: np.ndarray, keep: bool = False) -> np.ndarray:
        self.pooled = self.words.forward(gates, codes, sizes, keep)
        return squash(self.pooled @ self.params["out"] + self.params["out_bias"])

    def learn(self, spelled: np.ndarray, letters: np.ndarray, known: np.ndarray, codes: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> Params:
        """Gradients of the mean log loss of a batch of windows."""
        found = self.windows(self.word_gates(spelled, letters, known, True), codes, sizes, True)
        grads = {k: np.zeros_like(v) for k, v in self.params.items()}
        slope = ((found - labels) / len(labels)).astype(np.float32)
        grads["out"] += self.pooled.T @ slope
        grads["out_bias"] += slope.sum()
        d_gates = self.words.backward(slope[:, None] * self.params["out"][None], grads)
        d_inputs = self._project_back("w", self.inputs, d_gates, grads)
        grads["words"] += _row_sums(d_inputs[:, :WORD_DIM], known, len(grads["words"]))
        d_chars = self.chars.backward(np.ascontiguousarray(d_inputs[:, WORD_DIM:]), grads)
        grads["chars"] += self._project_back("c", self.params["chars"], d_chars, grads)
        return grads

    def _project_back(self, name: str, inputs: np.ndarray, d_gates: np.ndarray, grads: Params) -> np.ndarray:
        grads[f"{name}_in"] += inputs.T @ d_gates
        grads[f"{name}_bias"] += d_gates.sum(1, keepdims=True)
        return (d_gates @ self.params[f"{name}_in"].transpose(0, 2, 1)).sum(0)


class Adam:
    def __init__(self, params: Params, rate: float = 0.01) -> None:
        self.params, self.rate, self.steps = params, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in params.items()}
        self.power = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: Params) -> None:
        self.steps += 1
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        shrink = min(1.0, 5.0 / max(size, 1e-9))
        rate = self.rate * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
        for k, g in grads.items():
            g = g * shrink
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.power[k] += 0.001 * (g * g - self.power[k])
            self.params[k] -= (rate * self.mean[k] / (np.sqrt(self.power[k]) + 1e-8)).astype(np.float32)
