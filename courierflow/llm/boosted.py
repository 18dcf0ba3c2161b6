"""Gradient-boosted trees on logistic loss, over quantile bins, with Platt calibration."""

from __future__ import annotations

import numpy as np

ROUNDS, DEPTH, RATE, BINS = 40, 3, 0.3, 24


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BoostedTrees:
    """Full binary trees: node ``k`` has the children ``2k + 1`` and ``2k + 2``. Row ``k`` counts ``n[k]`` times."""

    def __init__(self, x: np.ndarray, y: np.ndarray, n: np.ndarray):
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        bins = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rate = np.clip((n * y).sum() / n.sum(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(rate / (1 - rate)))
        margin = np.full(len(y), self.start)
        inner = 2**DEPTH - 1
        for _ in range(ROUNDS):
            p = sigmoid(margin)
            g, h = n * (y - p), n * p * (1 - p)
            feature, cut, node = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(len(y), int)
            for k in range(inner):
                at = np.flatnonzero(node == k)
                best = 1e-6
                for f, e in enumerate(edges):
                    if not len(e) or not len(at):
                        continue
                    gs, hs = (np.cumsum(np.bincount(bins[at, f], w[at], len(e) + 1)) for w in (g, h))
                    gain = gs[:-1] ** 2 / (hs[:-1] + 1) + (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + 1) - gs[-1] ** 2 / (hs[-1] + 1)
                    if gain.max() > best:
                        best, feature[k], cut[k] = gain.max(), f, e[int(gain.argmax())]
                node[at] = 2 * k + 1 + (x[at, feature[k]] > cut[k])
            leaf = node - inner
            value = RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
            self.trees.append((feature, cut, value))
            margin += value[leaf]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += value[node - len(feature)]
        return out


class Calibrated:
    """Trees, the line that turns margins into probabilities, and the threshold to act on.

    Trees learn from two thirds of the rows. On the rest, the threshold is the least probability
    from which on at least ``precision`` of the rows are positive, never under ``floor``. A row may
    stand for ``n`` equal ones, with ``y`` the positive share of them; they stay on one side.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray, n: np.ndarray | None = None, precision: float = 0.98, floor: float = 0.8):
        self.trees, self.line, self.threshold = None, (1.0, 0.0), 2.0
        n = np.ones(len(y)) if n is None else n
        held = np.arange(len(y)) % 3 == 0
        if min((n * y)[~held].sum(), (n * y)[held].sum(), (n * (1 - y))[~held].sum()) < 5:
            return
        self.trees = BoostedTrees(x[~held], y[~held], n[~held])
        m, t, n = self.trees.margin(x[held]), y[held], n[held]

        def loss(line: np.ndarray) -> float:
            z = line[0] * m + line[1]
            return float((n * (np.logaddexp(0, z) - t * z)).sum() + ((line[0] - 1) ** 2 + line[1] ** 2) / 2)

        line = np.array([1.0, 0.0])
        for _ in range(50):  # Newton steps with a light pull to (1, 0), halved until they gain
            p = sigmoid(line[0] * m + line[1])
            w = n * p * (1 - p)
            grad = np.array([(n * (t - p) * m).sum() - (line[0] - 1), (n * (t - p)).sum() - line[1]])
            hess = np.array([[(w * m * m).sum() + 1, (w * m).sum()], [(w * m).sum(), w.sum() + 1]])
            step = np.linalg.solve(hess, grad)
            while loss(line + step) > loss(line) and np.abs(step).max() > 1e-9:
                step = step / 2
            line = line + step
        self.line = (float(line[0]), float(line[1]))
        order = np.argsort(-self.probability(x[held]))
        good = np.cumsum((n * t)[order]) / np.cumsum(n[order]) >= precision
        if good.any():
            self.threshold = max(floor, float(self.probability(x[held])[order][np.flatnonzero(good)[-1]]))

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None or not len(x):
            return np.zeros(len(x))
        return sigmoid(self.line[0] * self.trees.margin(x) + self.line[1])
