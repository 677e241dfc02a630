"""A linear-chain conditional random field with two labels, in NumPy.

The state of a chain of two labels is one number, the odds of label 1 against label 0, and a step maps odds o to
exp(e) * (w11 * o + w01) / (w10 * o + w00). Steps compose like 2x2 matrices, so long sequences are cut into segments:
the products of all segments are taken side by side, then chained, then all segments are run side by side from their
true beginnings. The result is exact, and the number of NumPy calls does not follow the length of the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

SEGMENT = 96
_FAR = 30.0


def _forward(gain: np.ndarray, place: np.ndarray, w: np.ndarray, begin: float = 1.0) -> np.ndarray:
    """Odds at each position of the sequences [place[i], place[i + 1]) with exp(e) = gain."""
    lengths = np.diff(place)
    full = np.flatnonzero(lengths > 0)
    if not len(full):
        return np.zeros(0)
    pieces = -(-lengths[full] // SEGMENT)
    owner = np.repeat(np.arange(len(full)), pieces)
    first = np.cumsum(pieces) - pieces
    ordinal = np.arange(len(owner)) - first[owner]
    start = place[full][owner] + ordinal * SEGMENT
    size = np.minimum(SEGMENT, place[full + 1][owner] - start)
    order = np.argsort(-size, kind="stable")
    start_sorted, size_sorted = start[order], size[order]
    active = np.searchsorted(-size_sorted, -np.arange(1, SEGMENT + 1), "right")
    w00, w01, w10, w11 = w.ravel()

    # Products of whole segments as maps of (weight of 0, weight of 1), for segments that another follows. The first
    # position of a text has no step, only its gain.
    head = (ordinal == 0)[order]
    m = np.zeros((4, len(order)))
    m[0] = m[3] = 1.0
    followed = int(active[-1]) if pieces.max() > 1 else 0
    if followed:
        base, heads = start_sorted[:followed], head[:followed]
        for t in range(SEGMENT):
            g = gain[base + t]
            a, b, c, d = m[:, :followed]
            new = np.stack([w00 * a + w10 * c, w00 * b + w10 * d, g * (w01 * a + w11 * c), g * (w01 * b + w11 * d)])
            if t == 0:
                new[:, heads] = np.stack([a, b, g * c, g * d])[:, heads]
            m[:, :followed] = new
            if t % 8 == 7:
                m[:, :followed] /= np.maximum(m[:, :followed].max(0), 1e-300)
    unsorted = np.empty_like(m)
    unsorted[:, order] = m

    before = np.full(len(owner), begin)
    if followed:
        state = np.stack([np.ones(len(full)), np.full(len(full), begin)])
        for k in range(int(pieces.max()) - 1):
            going = np.flatnonzero(pieces > k + 1)
            seg = first[going] + k
            a, b, c, d = unsorted[:, seg]
            x, y = state[:, going]
            nx, ny = a * x + b * y, c * x + d * y
            top = np.maximum(nx, ny)
            state[:, going] = nx / top, ny / top
            before[seg + 1] = ny / np.maximum(nx, 1e-300)
    out = np.empty(len(gain))
    odds = before[order]
    for t in range(int(size_sorted[0])):
        n = int(active[t])
        o = odds[:n]
        o = np.where(head[:n], begin, (w11 * o + w01) / (w10 * o + w00)) if t == 0 else (w11 * o + w01) / (w10 * o + w00)
        o = np.clip(gain[start_sorted[:n] + t] * o, 1e-13, 1e13)
        out[start_sorted[:n] + t] = o
        odds[:n] = o
    return out


def posterior(scores: np.ndarray, place: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probability of label 1 at each position, forward odds, backward odds that hold the position's own score).

    scores are log-odds of label 1 by position, w the 2x2 transition weights.
    """
    gain = np.exp(np.clip(scores, -_FAR, _FAR))
    o = _forward(gain, place, w)
    n = place[-1]
    g = _forward(gain[::-1], (n - place)[::-1], w.T)[::-1]
    both = o * g / gain
    return both / (1 + both), o, g


def _step(odds: float, w: np.ndarray) -> float:
    return float((w[1, 1] * odds + w[0, 1]) / (w[1, 0] * odds + w[0, 0]))


def posterior_windows(scores: np.ndarray, w: np.ndarray, window: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(start, stop, probabilities of label 1) of one long sequence, from its last window to its first.

    The odds at the beginning of each window are carried over from the last one, so the result is that of posterior(),
    with the memory of a window besides the scores.
    """
    ranges = [(a, min(a + window, len(scores))) for a in range(0, len(scores), window)]
    gain = lambda a, b: np.exp(np.clip(scores[a:b], -_FAR, _FAR))
    begins = [1.0]
    for a, b in ranges[:-1]:
        begins.append(_step(_forward(gain(a, b), np.array([0, b - a]), w, begins[-1])[-1], w))
    behind = 1.0
    for (a, b), begin in zip(reversed(ranges), reversed(begins), strict=True):
        own, place = gain(a, b), np.array([0, b - a])
        g = _forward(own[::-1], place, w.T, behind)[::-1]
        both = _forward(own, place, w, begin) * g / own
        yield a, b, both / (1 + both)
        behind = _step(g[0], w.T)


@dataclass
class Chain:
    """Weights of a chain: of sparse features (ids by position), dense features, and transitions (as logarithms)."""

    sparse: np.ndarray = field(default_factory=lambda: np.zeros(0))
    dense: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    transitions: np.ndarray = field(default_factory=lambda: np.array([[0.3, 0.0], [0.0, 0.25]]))

    def scores(self, ids: np.ndarray | None, values: np.ndarray | None) -> np.ndarray:
        out = np.full(len(ids) if ids is not None else len(values), self.bias)
        if ids is not None:
            for column in ids.T:
                out += self.sparse[column]
        if values is not None:
            out += values @ self.dense
        return out

    def windows(self, scores: np.ndarray, place: np.ndarray, window: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """(start, stop, marginals) of all sequences at once, or of one long one by windows."""
        w = np.exp(self.transitions)
        if len(place) == 2 and len(scores) > window:
            yield from posterior_windows(scores, w, window)
        elif len(scores):
            yield 0, len(scores), posterior(scores, place, w)[0]

    def marginals(self, ids: np.ndarray | None, values: np.ndarray | None, place: np.ndarray) -> np.ndarray:
        return posterior(self.scores(ids, values), place, np.exp(self.transitions))[0]


def train(ids: np.ndarray | None, values: np.ndarray | None, place: np.ndarray, labels: np.ndarray, n_sparse: int = 0, epochs: int = 12, batch_positions: int = 40_000, rate: float = 0.05, l2: float = 1e-5, least_steps: int = 300, seed: int = 7) -> Chain:
    """Maximum conditional likelihood by Adam over batches of whole sequences; deterministic for given arrays.

    Small samples get more epochs, so that there are about least_steps steps.
    """
    chain = Chain(np.zeros(n_sparse), np.zeros(values.shape[1] if values is not None else 0))
    lengths = np.diff(place)
    sequences = np.flatnonzero(lengths > 0)
    if not len(sequences):
        return chain
    rng = np.random.default_rng(seed)
    moments = {k: [0.0, 0.0] for k in ("sparse", "dense", "bias", "transitions")}
    step = 0
    for _ in range(max(epochs, -(-least_steps // max(1, -(-int(place[-1]) // batch_positions))))):
        shuffled = rng.permutation(sequences)
        groups = np.cumsum(lengths[shuffled]) // batch_positions
        for batch in np.split(shuffled, np.flatnonzero(np.diff(groups)) + 1):
            step += 1
            own = lengths[batch]
            at = np.concatenate([[0], np.cumsum(own)])
            rows = np.repeat(place[batch] - at[:-1], own) + np.arange(at[-1])
            x, v, y = ids[rows] if ids is not None else None, values[rows] if values is not None else None, labels[rows]
            w = np.exp(chain.transitions)
            p, o, g = posterior(chain.scores(x, v), at, w)
            error = (p - y) / len(rows)
            inner = np.ones(len(rows), bool)
            inner[at[:-1]] = False
            here = np.flatnonzero(inner)
            prev = here - 1
            joint = np.stack([np.ones(len(here)), g[here], o[prev], o[prev] * g[here]]) * w.ravel()[:, None]
            joint /= joint.sum(0)
            seen = np.bincount(2 * y[prev].astype(int) + y[here].astype(int), minlength=4)
            grads = {"bias": error.sum(), "transitions": ((joint.sum(1) - seen) / len(rows)).reshape(2, 2)}
            if x is not None:
                grads["sparse"] = np.bincount(x.ravel(), np.repeat(error, x.shape[1]), n_sparse) + l2 * chain.sparse
            if v is not None:
                grads["dense"] = v.T @ error + l2 * chain.dense
            for name, grad in grads.items():
                m = moments[name]
                m[0], m[1] = 0.9 * m[0] + 0.1 * grad, 0.999 * m[1] + 0.001 * grad * grad
                setattr(chain, name, getattr(chain, name) - rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-9))
    return chain


def logistic(features: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None, rounds: int = 60, l2: float = 1e-3) -> np.ndarray:
    """Weights (last: intercept) of a logistic regression by Newton steps."""
    x = np.hstack([features, np.ones((len(features), 1))])
    w = np.zeros(x.shape[1])
    weights = np.ones(len(x)) if weights is None else weights
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -_FAR, _FAR)))
        grad = x.T @ (weights * (p - labels)) + l2 * w
        hess = (x * (weights * p * (1 - p) + 1e-9)[:, None]).T @ x + l2 * np.eye(len(w))
        change = np.linalg.solve(hess, grad)
        w -= change * min(1.0, 4.0 / max(np.abs(change).max(), 1e-9))
        if np.abs(change).max() < 1e-7:
            break
    return w


def apply_logistic(w: np.ndarray, features: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ w[:-1] + w[-1], -_FAR, _FAR)))
