"""A small classification tree (Gini impurity, axis-parallel cuts) in numpy."""

from __future__ import annotations

import numpy as np


class Tree:
    """Fitted on rows of numbers with labels 0 and 1; predicts whole arrays at once."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, depth: int = 8):
        self.nodes: list[tuple[int, float, int, int]] = []  # feature (-1: leaf), cut, left or label, right
        self._grow(np.asarray(rows, float), np.asarray(labels, int), depth)

    def _grow(self, rows: np.ndarray, labels: np.ndarray, depth: int) -> int:
        at = len(self.nodes)
        self.nodes.append((-1, 0.0, int(2 * labels.sum() > len(labels)), 0))
        cut = self._best_cut(rows, labels) if depth and 0 < labels.sum() < len(labels) else None
        if cut:
            feature, value = cut
            low = rows[:, feature] <= value
            left = self._grow(rows[low], labels[low], depth - 1)
            right = self._grow(rows[~low], labels[~low], depth - 1)
            self.nodes[at] = (feature, value, left, right)
        return at

    @staticmethod
    def _best_cut(rows: np.ndarray, labels: np.ndarray) -> tuple[int, float] | None:
        best, found = np.inf, None
        for feature in range(rows.shape[1]):
            values = np.unique(rows[:, feature])
            for value in (values[1:] + values[:-1]) / 2:
                low = rows[:, feature] <= value
                sides = labels[low], labels[~low]
                impurity = sum(len(s) * s.mean() * (1 - s.mean()) for s in sides)
                if impurity < best - 1e-12:
                    best, found = impurity, (feature, float(value))
        return found

    def predict(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), int)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            feature, value, left, right = self.nodes[node]
            if feature < 0:
                out[at] = left
            elif len(at):
                low = rows[at, feature] <= value
                todo += [(left, at[low]), (right, at[~low])]
        return out
