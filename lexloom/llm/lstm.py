"""A small bidirectional LSTM in numpy: fitted by back-propagation through time, run in windows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

#: Numbers of input held at once when sequences are labelled, about.
CELLS = 4_000_000
#: Sequences that are read side by side.
SIDE = 128


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Direction:
    """Gates in the order input, forget, output, candidate; `head` turns a state into its part of the score."""

    wx: np.ndarray
    wh: np.ndarray
    b: np.ndarray
    head: np.ndarray

    def step(self, z: np.ndarray, h: np.ndarray, c: np.ndarray):
        """One step from `z`, the input times `wx` plus `b`."""
        n = h.shape[1]
        z = z + h @ self.wh
        gates = sigmoid(z[:, : 3 * n])
        g = np.tanh(z[:, 3 * n :])
        c = gates[:, n : 2 * n] * c + gates[:, :n] * g
        t = np.tanh(c)
        return gates, g, c, t, gates[:, 2 * n :] * t


@dataclass
class Labeller:
    """Score of an item: what it says itself, what comes before it, and what follows it."""

    ahead: Direction
    back: Direction
    own: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*vars(self.ahead).values(), *vars(self.back).values(), self.own, self.bias]


def blank(width: int, hidden: int, seed: int) -> Labeller:
    rng = np.random.default_rng(seed)

    def direction() -> Direction:
        b = np.zeros(4 * hidden, np.float32)
        b[hidden : 2 * hidden] = 1
        return Direction(
            rng.normal(0, 0.15, (width, 4 * hidden)).astype(np.float32), rng.normal(0, 0.15, (hidden, 4 * hidden)).astype(np.float32),
            b, rng.normal(0, 0.3, hidden).astype(np.float32),
        )

    return Labeller(direction(), direction(), np.zeros(width, np.float32), np.zeros(1, np.float32))


def _through(d: Direction, x: np.ndarray, there: np.ndarray):
    """States of all steps of x (time, sequence, input); padding keeps the state as it is."""
    steps, side, _ = x.shape
    z = x @ d.wx + d.b
    h = c = np.zeros((side, len(d.head)), np.float32)
    kept = []
    for t in range(steps):
        on = there[t][:, None]
        gates, g, new, tanh, out = d.step(z[t], h, c)
        kept.append((h, c, gates, g, tanh))
        h, c = np.where(on, out, h), np.where(on, new, c)
        kept[-1] += (h,)
    return kept


def _gradients(d: Direction, x: np.ndarray, there: np.ndarray, kept: list, dscore: np.ndarray) -> list[np.ndarray]:
    steps, side, width = x.shape
    n = len(d.head)
    dh = dc = np.zeros((side, n), np.float32)
    dz = np.zeros((steps, side, 4 * n), np.float32)
    dwh, dhead = np.zeros_like(d.wh), np.zeros_like(d.head)
    for t in range(steps - 1, -1, -1):
        h0, c0, gates, g, tanh, h = kept[t]
        on = there[t][:, None]
        dh = dh + dscore[t][:, None] * d.head
        dhead += dscore[t] @ h
        i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
        dnew = np.where(on, dh * o * (1 - tanh**2) + dc, 0)
        part = np.concatenate([dnew * g * i * (1 - i), dnew * c0 * f * (1 - f), dh * tanh * o * (1 - o), dnew * i * (1 - g**2)], 1)
        dz[t] = np.where(on, part, 0)
        dwh += h0.T @ dz[t]
        dc = np.where(on, dnew * f, dc)
        dh = np.where(on, dz[t] @ d.wh.T, dh)
    flat = dz.reshape(-1, 4 * n)
    return [x.reshape(-1, width).T @ flat, dwh, flat.sum(0), dhead]


def loss_and_gradients(model: Labeller, x: np.ndarray, there: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean logistic loss of x (time, sequence, input) with labels y, and its gradients by parameter."""
    ahead = _through(model.ahead, x, there)
    back = _through(model.back, x[::-1], there[::-1])
    score = np.stack([k[-1] @ model.ahead.head for k in ahead]) + np.stack([k[-1] @ model.back.head for k in back])[::-1] + x @ model.own + model.bias
    p = sigmoid(score)
    n = max(1, int(there.sum()))
    loss = float((np.where(there, np.logaddexp(0, np.where(y == 1, -score, score)), 0)).sum() / n)
    d = np.where(there, p - y, 0).astype(np.float32) / n
    grads = _gradients(model.ahead, x, there, ahead, d) + _gradients(model.back, x[::-1], there[::-1], back, d[::-1])
    return loss, [*grads, np.tensordot(d, x, ((0, 1), (0, 1))), np.array([d.sum()], np.float32)]


def fit(sequences: list[tuple[np.ndarray, np.ndarray]], hidden: int = 24, rounds: int = 8, side: int = 32, rate: float = 0.02, seed: int = 3) -> Labeller:
    """Adam over batches of sequences of about one length; each is (inputs, labels)."""
    rng = np.random.default_rng(seed)
    model = blank(sequences[0][0].shape[1], hidden, seed)
    order = np.argsort([len(y) for _, y in sequences], kind="stable")
    batches = [order[i : i + side] for i in range(0, len(order), side)]
    values = model.parameters()
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    count, total = 0, rounds * len(batches)
    for _ in range(rounds):
        for b in rng.permutation(len(batches)):
            some = [sequences[i] for i in batches[b]]
            steps = max(len(y) for _, y in some)
            x = np.zeros((steps, len(some), some[0][0].shape[1]), np.float32)
            y, there = np.zeros(x.shape[:2], np.float32), np.zeros(x.shape[:2], bool)
            for j, (one, label) in enumerate(some):
                x[: len(label), j], y[: len(label), j], there[: len(label), j] = one, label, True
            _, grads = loss_and_gradients(model, x, there, y)
            norm = float(np.sqrt(sum((g**2).sum() for g in grads)))
            count += 1
            now = rate * (1 - (count - 1) / total)
            for v, g, m, s in zip(values, grads, first, second):
                g = g * min(1.0, 1.0 / max(norm, 1e-9))
                m += 0.1 * (g - m)
                s += 0.001 * (g**2 - s)
                v -= (now * (m / (1 - 0.9**count)) / (np.sqrt(s / (1 - 0.999**count)) + 1e-8)).astype(v.dtype)
    return model


def scores(model: Labeller, lengths: np.ndarray, inputs: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Scores of all items of sequences that lie one after the other.

    `inputs` gives the rows of input of given items. Sequences of about one length are read
    side by side, in windows of time, so that memory does not grow with their length: only
    a state and one number an item are kept.
    """
    starts = np.concatenate([[0], np.cumsum(lengths)])
    out = np.full(starts[-1], model.bias[0], np.float32)
    order = np.argsort(lengths, kind="stable")
    width = len(model.own)
    for at in range(0, len(order), SIDE):
        some = order[at : at + SIDE]
        size, begin = lengths[some], starts[:-1][some]
        window = max(1, CELLS // (width * len(some)))
        spans = [(s, min(int(size.max()), s + window)) for s in range(0, int(size.max()), window)]
        x, held = None, None
        for d, parts, ahead in ((model.ahead, spans, True), (model.back, spans[::-1], False)):
            h = c = np.zeros((len(some), len(d.head)), np.float32)
            for a, b in parts:
                there = np.arange(a, b)[:, None] < size[None]
                items = (begin[None] + np.arange(a, b)[:, None])[there]
                if held != (a, b):
                    x, held = inputs(items), (a, b)
                if ahead:
                    out[items] += x @ model.own
                z = np.zeros((b - a, len(some), len(d.b)), np.float32)
                z[there] = x @ d.wx + d.b
                part = np.zeros((b - a, len(some)), np.float32)
                for t in range(b - a) if ahead else range(b - a - 1, -1, -1):
                    on = there[t][:, None]
                    _, _, new, _, state = d.step(z[t], h, c)
                    h, c = np.where(on, state, h), np.where(on, new, c)
                    part[t] = h @ d.head
                out[items] += part[there]
    return out
