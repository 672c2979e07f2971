"""Gradient-boosted trees over histograms, in numpy.

Features are cut into bins once; a tree grows level by level from sums per bin.
Trees are complete and kept as arrays: node *i* has the children 2i+1 and 2i+2,
so a batch of rows walks down all levels at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """``feature`` and ``threshold`` per tree and inner node, ``value`` per tree
    and leaf; ``base`` is the score in log odds before the first tree."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def probability(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of features."""
        score = np.full(len(rows), self.base)
        index = np.arange(len(rows))
        inner = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(rows), dtype=np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (rows[index, feature[node]] > threshold[node])
            score += value[node - inner]
        return 1 / (1 + np.exp(-score))


def fit(
    rows: np.ndarray,
    labels: np.ndarray,
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    least: int = 20,
    ridge: float = 1.0,
) -> Trees:
    """Boosted trees for logistic loss; the same rows give the same trees.

    Without rows the probability is one half; with one class only it is that
    class's, softened by one row of each class.
    """
    inner, leaves = (1 << depth) - 1, 1 << depth
    positive = float(labels.sum())
    base = float(np.log((positive + 1) / (len(labels) - positive + 1)))
    if not len(labels) or positive in (0.0, float(len(labels))):
        trees = 0
    features = rows.shape[1]
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(features)] if trees else []
    binned = np.stack([np.searchsorted(cuts[f], rows[:, f], side="left") for f in range(features)], axis=1) if trees else None
    all_feature = np.zeros((trees, inner), dtype=np.int64)
    all_threshold = np.full((trees, inner), np.inf)
    all_value = np.zeros((trees, leaves))
    score = np.full(len(labels), base)
    for tree in range(trees):
        chance = 1 / (1 + np.exp(-score))
        slope, curve = labels - chance, chance * (1 - chance)
        node = np.zeros(len(labels), dtype=np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            local = node - first
            gain, where = np.zeros(width), np.full((width, 2), -1)
            for f in range(features):
                cell = local * bins + binned[:, f]
                sums = [
                    np.bincount(cell, weights=w, minlength=width * bins).reshape(width, bins).cumsum(axis=1)
                    for w in (slope, curve, np.ones(len(labels)))
                ]
                (s, c, n), (ts, tc, tn) = sums, [x[:, -1:] for x in sums]
                with np.errstate(divide="ignore", invalid="ignore"):
                    better = s**2 / (c + ridge) + (ts - s) ** 2 / (tc - c + ridge) - ts**2 / (tc + ridge)
                better[(n < least) | (tn - n < least)] = 0
                best = better[:, : len(cuts[f])].argmax(axis=1) if len(cuts[f]) else np.zeros(width, dtype=int)
                won = better[np.arange(width), best] > gain + 1e-9 if len(cuts[f]) else np.zeros(width, dtype=bool)
                gain[won] = better[np.arange(width), best][won]
                where[won] = np.stack([np.full(width, f), best], axis=1)[won]
            for at, (f, cut) in enumerate(where):
                if f >= 0:
                    all_feature[tree, first + at] = f
                    all_threshold[tree, first + at] = cuts[f][cut]
            node = 2 * node + 1 + (rows[np.arange(len(rows)), all_feature[tree, node]] > all_threshold[tree, node])
        leaf = node - inner
        sums = [np.bincount(leaf, weights=w, minlength=leaves) for w in (slope, curve)]
        all_value[tree] = rate * sums[0] / (sums[1] + ridge)
        score += all_value[tree][leaf]
    return Trees(base, all_feature, all_threshold, all_value)
