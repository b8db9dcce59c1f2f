"""Logistic regression over hashed sparse rows, fitted on a bounded sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Rows:
    """Sparse rows in compressed form."""

    first: np.ndarray  # rows + 1
    index: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
        size = [len(i) for i, _ in rows]
        empty = [np.zeros(0, np.int64)]
        return cls(np.append(0, np.cumsum(size, dtype=np.int64)).astype(np.int64), np.concatenate([i for i, _ in rows] or empty).astype(np.int64), np.concatenate([v for _, v in rows] or empty).astype(np.float64))

    def take(self, keep: np.ndarray) -> Rows:
        """The rows for which ``keep`` is true."""
        size = np.diff(self.first)
        cells = np.repeat(keep, size)
        return Rows(np.append(0, np.cumsum(size[keep])), self.index[cells], self.value[cells])

    def only(self, feature: np.ndarray) -> Rows:
        """The cells whose feature is marked."""
        cells = feature[self.index]
        row = np.repeat(np.arange(len(self)), np.diff(self.first))[cells]
        return Rows(np.append(0, np.cumsum(np.bincount(row, minlength=len(self)))), self.index[cells], self.value[cells])

    def dot(self, weight: np.ndarray) -> np.ndarray:
        total = np.append(0.0, np.cumsum(self.value * weight[self.index]))
        return total[self.first[1:]] - total[self.first[:-1]]


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit(rows: Rows, target: np.ndarray, dims: int, *, l2: float = 1e-3, steps: int = 150, rate: float = 0.1) -> np.ndarray:
    """Weights (dims) and bias (last) for targets in 0..1, by Adam over all rows.

    Deterministic. Without rows the weights are zero; with one class alone the
    bias carries it."""
    weight = np.zeros(dims + 1)
    if not len(rows):
        return weight
    used = np.unique(rows.index)
    rows = Rows(rows.first, np.searchsorted(used, rows.index), rows.value)
    of = np.repeat(np.arange(len(rows)), np.diff(rows.first))
    share = np.clip(target.mean(), 1e-4, 1 - 1e-4)
    w, bias = np.zeros(len(used)), float(np.log(share / (1 - share)))
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for t in range(1, steps + 1):
        error = (sigmoid(rows.dot(w) + bias) - target) / len(rows)
        g = np.append(np.bincount(rows.index, weights=rows.value * error[of], minlength=len(used)) + l2 * w, error.sum())
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
        w -= step[:-1]
        bias -= step[-1]
    weight[used] = w
    weight[-1] = bias
    return weight
