"""A linear-chain conditional random field with two labels, on flat NumPy arrays.

All sequences of a batch lie one after the other. The forward and the backward recursion are products of
2 x 2 matrices; at the edge of a sequence the matrix forgets what came before, so one scan serves all
sequences. Blocks are multiplied side by side, block products are scanned by doubling, and a second
sweep gives every message: no loop runs over the tokens of a long document."""

from __future__ import annotations

import numpy as np

BLOCK = 64
#: tokens whose messages are computed at once
PART = 1 << 17


def _chain(m: np.ndarray) -> np.ndarray:
    """Normalised row vectors v_t = v_(t-1) M_t for matrices m[4, n] (00, 01, 10, 11)."""
    n = m.shape[1]
    blocks = -(-n // BLOCK)
    grid = np.zeros((4, blocks * BLOCK))
    grid[[0, 3]] = 1.0
    grid[:, :n] = m
    grid = np.ascontiguousarray(grid.reshape(4, blocks, BLOCK).transpose(2, 0, 1))
    p = grid[0].copy()
    for q in grid[1:]:
        p = np.stack([p[0] * q[0] + p[1] * q[2], p[0] * q[1] + p[1] * q[3], p[2] * q[0] + p[3] * q[2], p[2] * q[1] + p[3] * q[3]])
        p /= p.sum(0)
    step = 1
    while step < blocks:
        a, q = p[:, :-step], p[:, step:]
        r = np.stack([a[0] * q[0] + a[1] * q[2], a[0] * q[1] + a[1] * q[3], a[2] * q[0] + a[3] * q[2], a[2] * q[1] + a[3] * q[3]])
        p[:, step:] = r / r.sum(0)
        step *= 2
    v = np.full((2, blocks), 0.5)
    v[0, 1:], v[1, 1:] = p[0, :-1] + p[2, :-1], p[1, :-1] + p[3, :-1]
    v /= v.sum(0)
    out = np.empty((BLOCK, 2, blocks))
    for i, q in enumerate(grid):
        v = np.stack([v[0] * q[0] + v[1] * q[2], v[0] * q[1] + v[1] * q[3]])
        v /= v.sum(0)
        out[i] = v
    return out.transpose(1, 2, 0).reshape(2, -1)[:, :n]


def messages(e: np.ndarray, first: np.ndarray, trans: np.ndarray):
    """Forward and backward messages. e: score of label 1 against 0 of each token; first: is the first of
    its sequence; trans[2, 2]: transition scores (from, to)."""
    x = np.exp(np.clip(e, -40, 40))
    top = np.maximum(x, 1.0)
    lo, hi = 1.0 / top, x / top
    t = np.exp(trans)
    ahead = np.where(first, 1.0, np.array([t[0, 0], t[0, 1], t[1, 0], t[1, 1]])[:, None])
    forward = _chain(ahead * np.stack([lo, hi, lo, hi]))
    # backward in reverse order: the matrix at t holds token t + 1's emission; 1 at the last token
    last = np.append(first[1:], True)
    lo, hi = np.append(lo[1:], 1.0), np.append(hi[1:], 1.0)
    back = np.where(last, 1.0, np.stack([t[0, 0] * lo, t[1, 0] * lo, t[0, 1] * hi, t[1, 1] * hi]))
    backward = _chain(back[:, ::-1])[:, ::-1]
    return forward, backward


def _parts(first: np.ndarray):
    """Ranges of whole sequences of about ``PART`` tokens (a longer sequence is a range of its own), so that
    the messages of all tokens never stand in memory together."""
    start = np.flatnonzero(first)
    lo = 0
    while lo < len(first):
        at = np.searchsorted(start, lo + PART, side="right") - 1
        at += start[at] <= lo
        hi = int(start[at]) if at < len(start) and lo + PART < len(first) else len(first)
        yield lo, hi
        lo = hi


def marginals(e: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Probability of label 1 of each token."""
    out = np.zeros(len(e))
    for lo, hi in _parts(first):
        f, b = messages(e[lo:hi], first[lo:hi], trans)
        p = f * b
        out[lo:hi] = p[1] / p.sum(0)
    return out


def fit(score, gradient, size: int, y: np.ndarray, first: np.ndarray, steps: int, l2: float, rate: float = 0.3):
    """Weights and transitions by Adam on the conditional log-likelihood. score(w) gives e, gradient(d)
    the weights' gradient of residuals d."""
    w, trans = np.zeros(size), np.zeros((2, 2))
    seen = np.zeros((2, 2))
    inner = ~first
    np.add.at(seen, (y[:-1][inner[1:]], y[1:][inner[1:]]), 1)
    m, v = np.zeros(size + 4), np.zeros(size + 4)
    n = len(y)
    for k in range(1, steps + 1):
        e = score(w)
        t = np.exp(trans)
        rest, pairs = np.empty(n), np.zeros(4)
        for lo, hi in _parts(first):
            f, b = messages(e[lo:hi], first[lo:hi], trans)
            p = f * b
            rest[lo:hi] = y[lo:hi] - p[1] / p.sum(0)
            x = np.exp(np.clip(e[lo:hi], -40, 40))
            emit = np.stack([1.0 / np.maximum(x, 1), x / np.maximum(x, 1)])
            pair = np.stack([f[i, :-1] * t[i, j] * emit[j, 1:] * b[j, 1:] for i in (0, 1) for j in (0, 1)])
            pairs += (pair / pair.sum(0))[:, inner[lo + 1:hi]].sum(1)
        g = np.append(gradient(rest) / n - l2 * w, ((seen - pairs.reshape(2, 2)) / n - l2 * trans).ravel())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        d = rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
        w, trans = w + d[:size], trans + d[size:].reshape(2, 2)
    return w, trans


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Weights (last: intercept) of a ridge logistic regression by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + l2 * len(x) / 100 * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - p) - l2 * len(x) / 100 * w)
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
