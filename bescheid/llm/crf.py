"""Linear-chain conditional random fields in numpy: marginals, training, Viterbi."""

from __future__ import annotations

import numpy as np


def _groups(lengths: np.ndarray, cells: int = 200_000) -> list[np.ndarray]:
    """Sequence numbers, longest first, in groups whose padded size stays bounded."""
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    out, at = [], 0
    while at < len(order):
        n = max(1, cells // int(lengths[order[at]]))
        out.append(order[at : at + n])
        at += n
    return out


def marginals(unary: np.ndarray, trans: np.ndarray, lengths: np.ndarray, pairs: bool = False):
    """Forward-backward over sequences that follow each other in `unary` (n x K): P(label), and pair counts.

    Potentials are scaled at each step, so any length is stable.
    """
    k = unary.shape[1]
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    pot = np.exp(np.maximum(unary - unary.max(axis=1, keepdims=True), -60)) if len(unary) else unary
    psi = np.exp(np.clip(trans, -30, 30))
    out, counts, loglik = np.empty_like(unary), np.zeros((k, k)), 0.0
    for g in _groups(lengths):
        n, steps = lengths[g], int(lengths[g[0]])
        live = np.searchsorted(-n, -np.arange(steps), side="left")  # sequences longer than t
        alpha = np.zeros((steps, len(g), k))
        beta = np.ones((steps, len(g), k))
        for t in range(steps):
            m = live[t]
            e = pot[first[g[:m]] + t]
            a = e if t == 0 else (alpha[t - 1, :m] @ psi) * e
            s = a.sum(axis=1, keepdims=True)
            loglik += float(np.log(s).sum())
            alpha[t, :m] = a / s
        for t in range(steps - 2, -1, -1):
            m = live[t + 1]
            eb = pot[first[g[:m]] + t + 1] * beta[t + 1, :m]
            b = eb @ psi.T
            if pairs:
                x = alpha[t, :m, :, None] * psi * eb[:, None, :]
                counts += (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            beta[t, :m] = b / b.sum(axis=1, keepdims=True)
        for t in range(steps):
            m = live[t]
            p = alpha[t, :m] * beta[t, :m]
            out[first[g[:m]] + t] = p / p.sum(axis=1, keepdims=True)
    if pairs:
        return out, counts, loglik + float(unary.max(axis=1).sum())
    return out


def train(x: np.ndarray, y: np.ndarray, lengths: np.ndarray, k: int, steps: int = 120, rate: float = 0.1, l2: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Weights (F x K) and transitions (K x K) for known labels `y`."""
    seen = np.zeros((k, k))
    inner = np.ones(len(y), bool)
    inner[np.cumsum(lengths)[lengths > 0] - 1] = False
    at = np.flatnonzero(inner)
    np.add.at(seen, (y[at], y[at + 1]), 1)
    return fit(x, np.eye(k)[y], seen, lengths, steps, rate, l2)


def fit(x: np.ndarray, share: np.ndarray, seen: np.ndarray, lengths: np.ndarray, steps: int = 120, rate: float = 0.1, l2: float = 1.0, start: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions by Adam on the mean expected log-likelihood; deterministic.

    `share` has the probability of each label at each place, `seen` the expected number of each pair of labels.
    """
    f, k = x.shape[1], share.shape[1]
    theta = np.zeros(f * k + k * k) if start is None else np.concatenate([p.ravel() for p in start])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for i in range(1, steps + 1):
        w, a = theta[: f * k].reshape(f, k), theta[f * k :].reshape(k, k)
        p, pair, _ = marginals(x @ w, a, lengths, pairs=True)
        g = np.concatenate(((x.T @ (share - p)).ravel(), (seen - pair).ravel())) / max(1, len(x)) - l2 / max(1, len(x)) * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
    return theta[: f * k].reshape(f, k), theta[f * k :].reshape(k, k)


def viterbi(unary: np.ndarray, trans: np.ndarray, edge: int | None = None) -> list[int]:
    """Best labels of one sequence; with `edge`, as if a certain `edge` label stood before and after it."""
    score = unary[0] + (trans[edge] if edge is not None else 0)
    back = []
    for u in unary[1:]:
        x = score[:, None] + trans
        back.append(x.argmax(axis=0))
        score = x.max(axis=0) + u
    if edge is not None:
        score = score + trans[:, edge]
    path = [int(score.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]
