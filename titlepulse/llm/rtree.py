"""R-tree over count vectors, packed bottom-up, for one bounded block.

Points are the group counts of shingle sets. An inner node keeps, over the
points below it, the largest count per group and the least set size. The
overlap of two sets is at most the sum of the smaller counts of each group,
so a node can hold a partner of a query only when the sum of the minima of
the query's counts and the node's largest counts is enough for a set of the
node's least size.
"""

from __future__ import annotations

import numpy as np

FAN = 16


def enough(overlap: np.ndarray, a, b, per: int = 100, need: int = 85) -> np.ndarray:
    """Whether an overlap of sets of a and b members can be ``need`` of
    ``per`` parts of their union: in whole numbers, without rounding."""
    return (per + need) * overlap >= need * (a + b)


class RTree:
    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        """points: n x groups counts; packed in tiles by size, then by the two
        groups that vary most."""
        spread = np.argsort(-points.var(axis=0))[:2] if len(points) else [0, 0]
        tile = np.argsort(np.argsort(sizes, kind="stable"), kind="stable") // (FAN * FAN)
        self.order = np.lexsort((points[:, spread[1]], points[:, spread[0]] // 4, tile))
        hi, lo = points[self.order], sizes[self.order]
        self.levels = [(hi, lo)]
        while len(lo) > FAN:
            cuts = np.arange(0, len(lo), FAN)
            hi, lo = np.maximum.reduceat(hi, cuts, axis=0), np.minimum.reduceat(lo, cuts)
            self.levels.append((hi, lo))

    def query(self, point: np.ndarray, size: int, need: int) -> np.ndarray:
        """Points that the bound allows as partners of ``point``."""
        nodes = np.arange(len(self.levels[-1][1]))
        for k in range(len(self.levels) - 1, -1, -1):
            hi, lo = self.levels[k]
            # An overlap also needs sizes that are near enough: b >= need/100 a.
            nodes = nodes[enough(np.minimum(hi[nodes], point).sum(1), size, lo[nodes], need=need)]
            if k:
                below = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
                nodes = below[below < len(self.levels[k - 1][1])]
        return self.order[nodes]
