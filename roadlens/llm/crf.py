"""A two-label linear-chain conditional random field over many short sequences (numpy).

A sequence is a row of token classes (0..classes-1; -1 past its end). The score of a labelling
adds, for every token with label 1, a weight of its own class, of the class before and of the
class after it, and for every pair of neighbours a transition weight. All sequences step
together, so a forward-backward pass costs as many numpy steps as the longest row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Field:
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    turn: np.ndarray  # 2 x 2

    def weights(self) -> np.ndarray:
        return np.concatenate([self.own, self.before, self.after, self.turn.reshape(-1)])

    @staticmethod
    def of(w: np.ndarray, classes: int) -> Field:
        return Field(w[:classes], w[classes : 2 * classes], w[2 * classes : 3 * classes], w[3 * classes :].reshape(2, 2))


def _neighbours(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes before and after each token (0 at the ends)."""
    before, after = np.zeros_like(seq), np.zeros_like(seq)
    before[:, 1:] = seq[:, :-1]
    after[:, :-1] = seq[:, 1:]
    return np.maximum(before, 0), np.maximum(after, 0)


def forward_backward(field: Field, seq: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Marginals of label 1 (rows x steps), pair marginals if asked for, and log partition sums."""
    n, steps = seq.shape
    there = seq >= 0
    before, after = _neighbours(seq)
    u = np.exp(np.clip(field.own[np.maximum(seq, 0)] + field.before[before] + field.after[after], -30, 30))
    u[~there] = 1
    a = np.exp(np.clip(field.turn, -30, 30))
    alpha, scale = np.empty((steps, 2, n)), np.ones((steps, n))
    now = np.stack([np.ones(n), u[:, 0]])
    for t in range(steps):
        if t:
            now = np.stack([alpha[t - 1, 0] * a[0, 0] + alpha[t - 1, 1] * a[1, 0], (alpha[t - 1, 0] * a[0, 1] + alpha[t - 1, 1] * a[1, 1]) * u[:, t]])
            now = np.where(there[:, t], now, alpha[t - 1])
        scale[t] = now.sum(0)
        alpha[t] = now / scale[t]
    beta = np.ones((2, n))
    p = np.zeros((n, steps))
    both = np.zeros((n, steps, 2, 2)) if pairs else None
    for t in range(steps - 1, -1, -1):
        g = alpha[t] * beta
        p[:, t] = np.where(there[:, t], g[1] / g.sum(0), 0)
        if not t:
            break
        right = np.stack([beta[0], beta[1] * u[:, t]])
        if pairs:
            x = alpha[t - 1][:, None] * a[:, :, None] * right[None]
            both[:, t] = np.where(there[:, t], x / x.sum((0, 1)), 0).transpose(2, 0, 1)
        left = np.stack([a[0, 0] * right[0] + a[0, 1] * right[1], a[1, 0] * right[0] + a[1, 1] * right[1]])
        beta = np.where(there[:, t], left / left.sum(0), beta)
    return p, both, np.log(scale).sum(0)


def chain_marginals(field: Field, classes: np.ndarray, bounds: np.ndarray, run: int) -> np.ndarray:
    """Marginals of label 1 of the tokens of whole texts (text i: ``bounds[i]`` to ``bounds[i + 1]``).

    Texts are laid out in rows of ``run`` tokens that step together. Each row's 2 x 2 product of
    steps carries the messages from row to row, so they cross the rows as if there were none.
    """
    size = np.diff(bounds)
    rows = -(-size // run)
    first = np.append(0, np.cumsum(rows))
    n = int(first[-1])
    if not n:
        return np.zeros(0)
    text = np.repeat(np.arange(len(size)), size)
    place = first[text] * run + np.arange(len(classes)) - bounds[text]
    before, after = np.append(0, classes[:-1]), np.append(classes[1:], 0)
    some = np.flatnonzero(size)
    before[bounds[some]] = 0
    after[bounds[some + 1] - 1] = 0
    flat = np.ones(n * run)
    flat[place] = np.exp(np.clip(field.own[classes] + field.before[before] + field.after[after], -30, 30))
    u = np.ascontiguousarray(flat.reshape(n, run).T)
    there = np.zeros(n * run, bool)
    there[place] = True
    there = np.ascontiguousarray(there.reshape(n, run).T)
    a = np.exp(np.clip(field.turn, -30, 30))
    # the turn into each step: none into a text's first token
    turn = np.broadcast_to(a[:, :, None], (2, 2, n)).copy()
    turn[:, :, first[some]] = np.eye(2)[:, :, None]

    def forth(x: np.ndarray, t: int) -> np.ndarray:
        k = turn if not t else a
        return np.where(there[t], np.stack([x[0] * k[0, 0] + x[1] * k[1, 0], (x[0] * k[0, 1] + x[1] * k[1, 1]) * u[t]]), x)

    # products of the rows' steps, by the label before the row
    product = np.stack([np.stack([np.ones(n), np.zeros(n)]), np.stack([np.zeros(n), np.ones(n)])])
    for t in range(run):
        product = np.stack([forth(product[0], t), forth(product[1], t)])
        product /= product.sum((0, 1))
    # messages into each row from the left and from the right, text by text, longest first
    order = some[np.argsort(-rows[some], kind="stable")]
    left, right = np.ones((2, n)), np.ones((2, n))
    counts = np.searchsorted(-rows[order], -np.arange(1, rows.max()))  # texts with more than j rows
    for j, c in enumerate(counts, 1):
        r = first[order[:c]] + j
        x = left[0, r - 1] * product[0][:, r - 1] + left[1, r - 1] * product[1][:, r - 1]
        left[:, r] = x / x.sum(0)
    for j, c in enumerate(counts, 1):
        r = first[order[:c] + 1] - 1 - j
        x = product[:, 0, r + 1] * right[0, r + 1] + product[:, 1, r + 1] * right[1, r + 1]
        right[:, r] = x / x.sum(0)
    alpha = np.empty((run, 2, n))
    for t in range(run):
        left = forth(left, t)
        left = left / left.sum(0)
        alpha[t] = left
    p = np.empty((n, run))
    for t in range(run - 1, -1, -1):
        g = alpha[t] * right
        p[:, t] = g[1] / g.sum(0)
        y = right[1] * u[t]
        k = turn if not t else a
        x = np.stack([k[0, 0] * right[0] + k[0, 1] * y, k[1, 0] * right[0] + k[1, 1] * y])
        right = np.where(there[t], x / x.sum(0), right)
    return p.reshape(-1)[place]


def train(seq: np.ndarray, label: np.ndarray, weight: np.ndarray, classes: int, rounds: int = 120, ridge: float = 1e-3, rate: float = 0.2) -> Field:
    """Weighted maximum likelihood by Adam steps on the exact gradient (observed minus expected counts)."""
    w = np.zeros(3 * classes + 4)
    w[:classes] = -2
    if not len(seq):
        return Field.of(w, classes)
    there = seq >= 0
    before, after = _neighbours(seq)
    y = (label * there).astype(float)
    total = weight.sum()

    def counts(p: np.ndarray, both: np.ndarray) -> np.ndarray:
        v = (p * weight[:, None])[there]
        parts = [np.bincount(c[there], v, classes) for c in (seq, before, after)]
        return np.concatenate([*parts, np.einsum("i,itab->ab", weight, both).reshape(-1)])

    seen = np.zeros((*seq.shape, 2, 2))
    li = label.astype(int)
    rows, steps = np.nonzero(there[:, 1:])
    seen[rows, steps + 1, li[rows, steps], li[rows, steps + 1]] = 1
    observed = counts(y, seen)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for i in range(1, rounds + 1):
        p, both, _ = forward_backward(Field.of(w, classes), seq, True)
        g = (observed - counts(p, both)) / total - ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w + rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    return Field.of(w, classes)
