"""A packed R-tree over group counts, joined with itself or another one.

A point holds how many members of a set fall in each group. Two sets share at most the summed
minima of their points, and no more than those of the upper corners of boxes that hold the
points. Two sets of sizes a and b with a Jaccard similarity of p percent share at least
p (a + b) / (100 + p); nodes whose bound stays below that for their smallest sizes are left out,
as are nodes whose sizes are too far apart, and nodes that hold one and the same group of sets.
"""

from __future__ import annotations

import numpy as np

FAN = 16
# Coordinates compared at a time.
_CELLS = 1 << 22


def shared_at_least(sizes: np.ndarray, percent: int) -> np.ndarray:
    """The overlap that sets of ``sizes`` in all need for that similarity."""
    return -(-percent * sizes // (100 + percent))


class CountTree:
    """Levels of nodes, from the points up to one node: each has the upper corner of its box,
    its least and greatest set size, and the group of its sets (-1: several)."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, groups: np.ndarray):
        self.order = np.lexsort((sizes, groups))
        at = self.order
        self.levels = [(points[at].astype(np.int32), sizes[at], sizes[at], groups[at])]
        while len(self.levels[-1][1]) > 1:
            high, least, most, group = self.levels[-1]
            start = np.arange(0, len(least), FAN)
            one = np.minimum.reduceat(group, start)
            self.levels.append((
                np.maximum.reduceat(high, start), np.minimum.reduceat(least, start),
                np.maximum.reduceat(most, start),
                np.where(one == np.maximum.reduceat(group, start), one, -1)))

    def _level(self, level: int) -> tuple[np.ndarray, ...]:
        return self.levels[min(level, len(self.levels) - 1)]

    def _children(self, nodes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each node at ``level``: where its children end, beginning at their first."""
        if level >= len(self.levels):
            return nodes, nodes + 1
        return nodes * FAN, np.minimum(nodes * FAN + FAN, len(self.levels[level - 1][1]))

    def join(self, other: "CountTree", percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of pairs of points, of different groups, that may have that similarity.

        Joined with itself, each pair comes once.
        """
        height = max(len(self.levels), len(other.levels)) - 1
        left = right = np.zeros(1, np.int64)
        for level in range(height, -1, -1):
            left, right = self._kept(other, level, left, right, percent)
            if level:
                left, right = self._below(other, level, left, right)
        return self.order[left], other.order[right]

    def _kept(self, other: "CountTree", level: int, left: np.ndarray, right: np.ndarray,
              percent: int) -> tuple[np.ndarray, np.ndarray]:
        high, least, most, group = self._level(level)
        other_high, other_least, other_most, other_group = other._level(level)
        keep = (100 * most[left] >= percent * other_least[right]) \
            & (100 * other_most[right] >= percent * least[left]) \
            & ((group[left] != other_group[right]) | (group[left] < 0))
        if other is self:
            keep &= left < right if level == 0 else left <= right
        left, right = left[keep], right[keep]
        needed = shared_at_least(least[left] + other_least[right], percent)
        bound = np.zeros(len(left), np.int64)
        step = max(1, _CELLS // high.shape[1])
        for at in range(0, len(left), step):
            some = slice(at, at + step)
            bound[some] = np.minimum(high[left[some]], other_high[right[some]]).sum(axis=1)
        return left[bound >= needed], right[bound >= needed]

    def _below(self, other: "CountTree", level: int, left: np.ndarray, right: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of children of pairs of nodes."""
        start, end = self._children(left, level)
        other_start, other_end = other._children(right, level)
        width = other_end - other_start
        count = (end - start) * width
        pair = np.repeat(np.arange(len(left)), count)
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return start[pair] + within // width[pair], other_start[pair] + within % width[pair]
