"""Histogram gradient-boosted trees for a yes/no label (numpy), scored by flat-array traversal.

Features are cut into at most 64 bins at quantiles of the training rows. A tree grows level by
level: a bincount over (node, bin) sums the log-loss gradients and Hessians, the best split of
a node is the cut with the largest gain, and leaves take a shrunken Newton step. The trees are
flattened into arrays (feature, limit, left, right, value), so scoring moves all rows one level
down per numpy step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    base: float
    feature: np.ndarray  # trees x nodes; leaves point to themselves
    limit: np.ndarray  # rows with value <= limit go left
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                low = x[rows, self.feature[t][at]] <= self.limit[t][at]
                at = np.where(low, self.left[t][at], self.right[t][at])
            out += self.value[t][at]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, least: float = 10.0, ridge: float = 1.0) -> Trees:
    """Boosted trees on rows ``x`` with labels ``y`` in {0, 1}; one label alone gives a constant."""
    n, d = x.shape if len(x) else (0, x.shape[1])
    share = (y.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    nodes = 2 ** (depth + 1) - 1
    empty = Trees(base, *(np.zeros((0, nodes), t) for t in (np.int64, float, np.int64, np.int64, float)), depth)
    if n < 2 or y.min() == y.max():
        return empty
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    binned = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])
    raw = np.full(n, base)
    flat: list[list[np.ndarray]] = [[], [], [], [], []]
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        feature, limit = np.zeros(nodes, np.int64), np.full(nodes, np.inf)
        left, right, value = np.arange(nodes), np.arange(nodes), np.zeros(nodes)
        at = np.zeros(n, np.int64)
        for level in range(depth + 1):
            first, wide = 2**level - 1, 2**level
            here = at >= first
            sums = [np.bincount(at[here] - first, v[here], wide) for v in (g, h)]
            value[first : first + wide] = rate * sums[0] / (sums[1] + ridge)
            if level == depth:
                break
            best, split = np.full(wide, 1e-6), np.full((wide, 2), -1)
            for j in range(d):
                width = len(cuts[j]) + 1
                key = (at[here] - first) * width + binned[here, j]
                gl, hl, cl = (np.bincount(key, v, wide * width).reshape(wide, width).cumsum(1)[:, :-1] for v in (g[here], h[here], np.ones(here.sum())))
                gt, ht = sums[0][:, None], sums[1][:, None]
                count = np.bincount(at[here] - first, minlength=wide)[:, None]
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                gain[(cl < least) | (count - cl < least)] = 0
                if not gain.shape[1]:
                    continue
                top = gain.argmax(1)
                better = gain[np.arange(wide), top] > best
                best[better] = gain[np.arange(wide), top][better]
                split[better] = np.column_stack([np.full(wide, j), top])[better]
            for i in np.flatnonzero(split[:, 0] >= 0):
                node, (j, b) = first + i, split[i]
                feature[node], limit[node] = j, cuts[j][b]
                left[node], right[node] = 2 * node + 1, 2 * node + 2
                own = at == node
                at[own] = np.where(binned[own, j] <= b, 2 * node + 1, 2 * node + 2)
        raw += value[at]
        for store, v in zip(flat, (feature, limit, left, right, value)):
            store.append(v)
    return Trees(base, *(np.array(v) for v in flat), depth)
