"""A bidirectional gated recurrent network over bytes, in numpy.

Two gated recurrent layers read a piece of text forwards and backwards; a linear layer on both states labels every
position. Gates use the piecewise linear sigmoid. Training is backpropagation through time with Adam. All arrays
have one row per piece, so that a step over thousands of pieces is a few array operations.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

NAMES = ("Ez", "Er", "Ec", "Uz", "Ur", "Uc")


@dataclass(frozen=True)
class Shape:
    """Sizes and training settings; ``piece`` is the number of bytes a state runs over."""

    units: int = 8
    piece: int = 128
    steps: int = 240
    rows: int = 256
    rate: float = 0.01
    seed: int = 11


def start_weights(classes: int, shape: Shape) -> dict[str, np.ndarray]:
    rng, units = np.random.default_rng(shape.seed), shape.units
    weights = {}
    for side in "fb":
        for name in NAMES:
            rows = 256 if name[0] == "E" else units
            weights[side + name] = (rng.standard_normal((rows, units)) * (0.3 if name[0] == "E" else units**-0.5)).astype(np.float32)
    weights["V"] = (rng.standard_normal((2 * units, classes)) * 0.3).astype(np.float32)
    weights["v"] = np.zeros(classes, np.float32)
    return weights


def _gate(x: np.ndarray) -> np.ndarray:
    x += 0.5
    return np.clip(x, 0, 1, out=x)


def _step(w: dict, side: str, symbols: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    z = _gate(w[side + "Ez"].take(symbols, axis=0) + h @ w[side + "Uz"])
    r = _gate(w[side + "Er"].take(symbols, axis=0) + h @ w[side + "Ur"])
    c = (r * h) @ w[side + "Uc"]
    c += w[side + "Ec"].take(symbols, axis=0)
    np.tanh(c, out=c)
    return z, r, c, h + z * (c - h)


def _softmax(logits: np.ndarray) -> np.ndarray:
    np.clip(logits, -30, 30, out=logits)
    e = np.exp(logits, out=logits)
    e /= e @ np.ones((e.shape[1], 1), np.float32)
    return e


def _gradients(
    w: dict, pieces: np.ndarray, label: np.ndarray, sizes: np.ndarray | None = None
) -> tuple[dict, float]:
    """Gradients of the mean cross-entropy over all positions of the pieces (rows x positions).

    Of padded pieces only the first ``sizes`` positions are read and count; every piece counts the same.
    """
    rows, length = pieces.shape
    padded = sizes is not None and bool((sizes < length).any())
    there = np.arange(length)[:, None] < sizes if padded else np.ones((length, rows), bool)
    units, classes = w["fUz"].shape[0], len(w["v"])
    tape: dict[str, list] = {}
    for side, order in (("f", range(length)), ("b", range(length - 1, -1, -1))):
        h, steps = np.zeros((rows, units), np.float32), [None] * length
        for t in order:
            z, r, c, new = _step(w, side, pieces[:, t], h)
            if padded:
                new = new * there[t][:, None]
            steps[t] = (z, r, c, h, new)
            h = new
        tape[side] = steps
    states = np.stack([np.hstack([tape["f"][t][4], tape["b"][t][4]]) for t in range(length)])
    p = _softmax((states.reshape(-1, 2 * units) @ w["V"]) + w["v"]).reshape(length, rows, classes)
    at = np.arange(rows)
    share = there / there.sum(0)
    loss = -float((np.log(p[:, at, label] + 1e-9) * share).sum() / rows)
    p[:, at, label] -= 1
    p *= (share / rows).astype(p.dtype)[:, :, None]
    grads = {name: np.zeros_like(value) for name, value in w.items()}
    grads["V"] = states.reshape(-1, 2 * units).T @ p.reshape(-1, classes)
    grads["v"] = p.sum((0, 1))
    into = p @ w["V"].T
    for side, order, half in (
        ("f", range(length - 1, -1, -1), slice(0, units)),
        ("b", range(length), slice(units, 2 * units)),
    ):
        carry = np.zeros((rows, units), np.float32)
        for t in order:
            z, r, c, h, _ = tape[side][t]
            g = carry + into[t][:, half]
            if padded:
                g *= there[t][:, None]
            dc = g * z * (1 - c * c)
            dz = g * (c - h) * ((z > 0) & (z < 1))
            drh = dc @ w[side + "Uc"].T
            dr = drh * h * ((r > 0) & (r < 1))
            carry = g * (1 - z) + drh * r + dz @ w[side + "Uz"].T + dr @ w[side + "Ur"].T
            grads[side + "Uc"] += (r * h).T @ dc
            grads[side + "Uz"] += h.T @ dz
            grads[side + "Ur"] += h.T @ dr
            order_of = np.argsort(pieces[:, t], kind="stable")
            symbols, firsts = np.unique(pieces[order_of, t], return_index=True)
            for name, d in (("Ez", dz), ("Er", dr), ("Ec", dc)):
                grads[side + name][symbols] += np.add.reduceat(d[order_of], firsts, axis=0)
    return grads, loss


def train(
    pieces: np.ndarray, label: np.ndarray, classes: int, shape: Shape, sizes: np.ndarray | None = None
) -> dict[str, np.ndarray]:
    """Weights fitted on pieces of bytes (rows x positions), padded from ``sizes`` on, and the class of each."""
    w = start_weights(classes, shape)
    rng = np.random.default_rng(shape.seed + 1)
    first = {name: np.zeros_like(value) for name, value in w.items()}
    second = {name: np.zeros_like(value) for name, value in w.items()}
    order = np.zeros(0, np.int64)
    for step in range(1, shape.steps + 1 if len(pieces) else 1):
        # Every piece once before any again.
        if len(order) < min(shape.rows, len(pieces)):
            order = np.concatenate([order, rng.permutation(len(pieces))])
        rows, order = order[: shape.rows], order[shape.rows :]
        rate = shape.rate * (1 - step / shape.steps) + 1e-4
        grads, _ = _gradients(w, pieces[rows], label[rows], None if sizes is None else sizes[rows])
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        for name, g in grads.items():
            g = g / max(1.0, size)
            first[name] += 0.1 * (g - first[name])
            second[name] += 0.01 * (g * g - second[name])
            up = first[name] / (1 - 0.9**step)
            w[name] -= (rate * up / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return w


def label_positions(w: dict, pieces: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Per piece, the weighted sum over its positions of the class probabilities.

    ``pieces`` and ``weight`` are positions x rows; a state stays zero where the weight is negative (padding).
    """
    length, rows = pieces.shape
    units, padded = w["fUz"].shape[0], bool((weight < 0).any())
    forward = np.empty((length, rows, units), np.float32)
    h = np.zeros((rows, units), np.float32)
    for t in range(length):
        h = _step(w, "f", pieces[t], h)[3]
        forward[t] = h
    out = np.zeros((rows, len(w["v"])), np.float32)
    h = np.zeros((rows, units), np.float32)
    top, low = w["V"][:units], w["V"][units:]
    for t in range(length - 1, -1, -1):
        h = _step(w, "b", pieces[t], h)[3]
        if padded:
            h *= (weight[t] >= 0)[:, None]
        p = forward[t] @ top
        p += h @ low
        p += w["v"]
        p = _softmax(p)
        p *= np.maximum(weight[t], 0)[:, None]
        out += p
    return out
