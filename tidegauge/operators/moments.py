"""Count, mean and squared deviations of runs of values, merged and never subtracted."""

from __future__ import annotations

import numpy as np

Moments = tuple[np.ndarray, np.ndarray, np.ndarray]


def merged(a: Moments, b: Moments) -> Moments:
    """Count, mean and squared deviations of two disjoint sets of values together."""
    (n_a, mean_a, dev_a), (n_b, mean_b, dev_b) = a, b
    n = n_a + n_b
    share = n_b / np.maximum(n, 1)
    apart = np.where((n_a > 0) & (n_b > 0), mean_b - mean_a, 0.0)
    mean = np.where(n_a > 0, mean_a + apart * share, mean_b)
    return n, mean, dev_a + dev_b + apart * apart * n_a * share


class MomentTree:
    """Moments of any run of rows, from nodes that hold 1, 2, 4, ... rows."""

    def __init__(self, values: np.ndarray, counted: np.ndarray):
        self._build(np.asarray(counted, "f8"), np.where(counted, values, 0.0), np.zeros(len(values)))

    @classmethod
    def over(cls, n: np.ndarray, mean: np.ndarray, dev: np.ndarray) -> MomentTree:
        """A tree whose leaves are sets of values already folded."""
        tree = cls.__new__(cls)
        tree._build(n, mean, dev)
        return tree

    def _build(self, *leaves: np.ndarray) -> None:
        size = 1 << max(0, len(leaves[0]) - 1).bit_length()
        n, mean, dev = (np.concatenate([x, np.zeros(size - len(x))]) for x in leaves)
        self.levels: list[Moments] = [(n, mean, dev)]
        while len(n) > 1:
            last = self.levels[-1]
            self.levels.append(merged(tuple(x[::2] for x in last), tuple(x[1::2] for x in last)))
            n = self.levels[-1][0]

    def moments(self, low: np.ndarray, high: np.ndarray) -> Moments:
        """Of the rows low, ..., high - 1 of each frame."""
        low, high = low.copy(), high.copy()
        left, right = (tuple(np.zeros(len(low)) for _ in range(3)) for _ in range(2))
        for level in self.levels:
            take = (low < high) & (low % 2 == 1)
            _add(left, take, level, low, True)
            low += take
            take = (low < high) & (high % 2 == 1)
            high -= take
            _add(right, take, level, high, False)
            low, high = low // 2, high // 2
        return merged(left, right)


def _add(total: Moments, take: np.ndarray, level: Moments, at: np.ndarray, after: bool) -> None:
    """Merge the nodes of one level into the totals of the frames that take one."""
    if take.any():
        own, nodes = tuple(x[take] for x in total), tuple(x[at[take]] for x in level)
        for x, new in zip(total, merged(own, nodes) if after else merged(nodes, own)):
            x[take] = new
