"""A linear-chain conditional random field over dense features, with training and Viterbi decoding in numpy.

Sequences are handled together, one step at a time, so that the work per item is that of a few vector operations.
"""

from __future__ import annotations

import numpy as np


class Chain:
    """weights: features x labels; moves: labels x labels; begin: labels."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, begin: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> None:
        self.weights, self.moves, self.begin, self.mean, self.scale = weights, moves, begin, mean, scale

    def scores(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def decode(self, x: np.ndarray, off: np.ndarray) -> np.ndarray:
        """The most probable labels of all items; sequence i has the items off[i] to off[i + 1]. Ties: lower label."""
        emit = self.scores(x)
        n_labels = emit.shape[1]
        size = np.diff(off)
        label = np.zeros(len(x), np.int64)
        order = np.argsort(-size, kind="stable")
        order = order[size[order] > 0]
        if not len(order):
            return label
        begin, size = off[order], size[order]
        back = np.zeros((len(x), n_labels), np.int8)
        best = emit[begin] + self.begin
        final = np.empty((len(order), n_labels))
        live = len(order)
        ends = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")  # sequences with at least t + 1 items
        for t in range(1, int(size[0])):
            now = int(ends[t])
            final[now:live] = best[now:live]
            best, live = best[:now], now
            step = best[:, :, None] + self.moves
            back[begin[:live] + t] = step.argmax(1)
            best = step.max(1) + emit[begin[:live] + t]
        final[:live] = best
        current = final.argmax(1)
        for t in range(int(size[0]) - 1, -1, -1):
            now = int(ends[t])
            at = begin[:now] + t
            label[at] = current[:now]
            current[:now] = back[at, current[:now]]
        return label


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def train(x: np.ndarray, off: np.ndarray, label: np.ndarray, n_labels: int, steps: int = 100, rate: float = 0.1, l2: float = 1e-4, longest: int = 32) -> Chain:
    """Maximum likelihood by Adam. Sequences are trained in pieces of at most `longest` items. label: -1 where unknown
    labels leave an item out of the observed side (its sequence is then skipped)."""
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = (x - mean) / scale
    pieces = [(a, min(a + longest, off[i + 1])) for i in range(len(off) - 1) for a in range(off[i], off[i + 1], longest)]
    pieces = sorted((p for p in pieces if (label[p[0] : p[1]] >= 0).all()), key=lambda p: p[0] - p[1])
    size = np.array([b - a for a, b in pieces])
    first = np.array([a for a, _ in pieces])
    most = int(size.max())
    at = first[:, None] + np.minimum(np.arange(most), size[:, None] - 1)
    mask = np.arange(most) < size[:, None]
    y = label[at]
    n_items = mask.sum()
    params = [np.zeros((x.shape[1], n_labels)), np.zeros((n_labels, n_labels)), np.zeros(n_labels)]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    one_hot = np.eye(n_labels)
    zp = z[at]
    seen = [np.einsum("stf,stl->fl", zp * mask[:, :, None], one_hot[y]), np.zeros((n_labels, n_labels)), one_hot[y[:, 0]].sum(0)]
    pair = mask[:, 1:]
    np.add.at(seen[1], (y[:, :-1][pair], y[:, 1:][pair]), 1)
    for step in range(1, steps + 1):
        weights, moves, begin = params
        emit = zp @ weights
        alpha, beta = np.empty_like(emit), np.zeros_like(emit)
        alpha[:, 0] = emit[:, 0] + begin
        for t in range(1, most):
            new = emit[:, t] + _log_sum(alpha[:, t - 1, :, None] + moves, 1)
            alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
        total = _log_sum(alpha[:, -1], 1)
        expected_moves = np.zeros_like(moves)
        for t in range(most - 2, -1, -1):
            ahead = emit[:, t + 1] + beta[:, t + 1]
            beta[:, t] = np.where(mask[:, t + 1, None], _log_sum(moves + ahead[:, None, :], 2), 0.0)
            both = np.exp(alpha[:, t, :, None] + moves + ahead[:, None, :] - total[:, None, None])
            expected_moves += (both * mask[:, t + 1, None, None]).sum(0)
        belief = np.exp(alpha + beta - total[:, None, None]) * mask[:, :, None]
        gradient = [seen[0] - np.einsum("stf,stl->fl", zp, belief), seen[1] - expected_moves, seen[2] - belief[:, 0].sum(0)]
        for i, p in enumerate(params):
            g = gradient[i] / n_items - l2 * p
            m1[i] = 0.9 * m1[i] + 0.1 * g
            m2[i] = 0.999 * m2[i] + 0.001 * g * g
            p += rate * (m1[i] / (1 - 0.9**step)) / (np.sqrt(m2[i] / (1 - 0.999**step)) + 1e-8)
    return Chain(params[0], params[1], params[2], mean, scale)
