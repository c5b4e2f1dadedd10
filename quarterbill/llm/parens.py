"""A tree as balanced parentheses, searched by blocks of least excess."""

from __future__ import annotations

import numpy as np

BLOCK = 64


class BlockMinima:
    """Least values over any range of an array: by element within a block, by table between."""

    def __init__(self, values: np.ndarray):
        self.values = values
        n = -(-len(values) // BLOCK)
        top = np.iinfo(values.dtype).max
        padded = np.full(max(n, 1) * BLOCK, top, values.dtype)
        padded[: len(values)] = values
        self.padded = padded
        self.levels = [padded.reshape(-1, BLOCK).min(1)]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            even = np.full(len(below) + len(below) % 2, top, values.dtype)
            even[: len(below)] = below
            self.levels.append(even.reshape(-1, 2).min(1))

    def over(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The least value in lo .. hi (inclusive) of each pair."""
        lo, hi = lo.copy(), hi + 1
        best = np.full(len(lo), np.iinfo(self.values.dtype).max, self.values.dtype)

        def take(level: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
            best[rows] = np.minimum(best[rows], level[at])

        for _ in range(BLOCK):  # up to the next whole block, and down to it
            rows = np.nonzero((lo < hi) & (lo % BLOCK != 0))[0]
            take(self.padded, lo[rows], rows)
            lo[rows] += 1
            rows = np.nonzero((lo < hi) & (hi % BLOCK != 0))[0]
            hi[rows] -= 1
            take(self.padded, hi[rows], rows)
        lo, hi = lo // BLOCK, np.maximum(hi // BLOCK, lo // BLOCK)
        for level in self.levels:
            rows = np.nonzero((lo < hi) & (lo & 1 == 1))[0]
            take(level, lo[rows], rows)
            lo[rows] += 1
            rows = np.nonzero((lo < hi) & (hi & 1 == 1))[0]
            hi[rows] -= 1
            take(level, hi[rows], rows)
            lo, hi = lo >> 1, hi >> 1
        return best

    def next_at_most(self, start: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The first place from `start` on whose value is at most `most`; there must be one."""
        at, found = start.copy(), np.zeros(len(start), bool)
        for _ in range(BLOCK):  # the rest of the block
            found |= self.padded[at] <= most
            rows = np.nonzero(~found & (at % BLOCK != BLOCK - 1))[0]
            if not len(rows):
                break
            at[rows] += 1
        rows = np.nonzero(~found)[0]
        block, level = at[rows] // BLOCK + 1, np.zeros(len(rows), np.int64)
        goal = most[rows]
        climbing = np.ones(len(rows), bool)
        while climbing.any():  # to a subtree of blocks that holds the goal
            for k in np.unique(level[climbing]):
                here = np.nonzero(climbing & (level == k))[0]
                good = self.levels[k][block[here]] <= goal[here]
                climbing[here[good]] = False
                here = here[~good]
                odd = block[here] & 1 == 1
                block[here] += 1
                block[here[odd]] >>= 1
                level[here[odd]] += 1
        for k in range(len(self.levels) - 1, 0, -1):  # and down to its first such block
            here = np.nonzero(level == k)[0]
            left = block[here] * 2
            block[here] = np.where(self.levels[k - 1][left] <= goal[here], left, left + 1)
            level[here] = k - 1
        inside = self.padded.reshape(-1, BLOCK)[block] <= goal[:, None]
        at[rows] = block * BLOCK + inside.argmax(1)
        return at


class Tree:
    """An ordered tree given by the depths of its nodes in preorder (the root has depth 0).

    A bit per parenthesis; a node's number is its rank among the opening ones.
    """

    def __init__(self, depths: np.ndarray):
        n = len(depths)
        closes = np.append(depths[:-1] - depths[1:] + 1, depths[-1] + 1 if n else 0)
        self.open = np.arange(n) + np.concatenate([[0], np.cumsum(closes[:-1])])
        self.bits = np.zeros(2 * n, bool)
        self.bits[self.open] = True
        excess = np.cumsum(np.where(self.bits, 1, -1))
        # the first place behind an opening one where the excess is below its own
        self.close = BlockMinima(excess).next_at_most(self.open, excess[self.open] - 1)
        self.last = np.cumsum(self.bits)[self.close] - 1  # number of the subtree's last node
        pairs = np.concatenate([self.bits[:-1] & ~self.bits[1:], [False]])
        self._leaves = np.concatenate([[0], np.cumsum(pairs)])
        self.depths = depths

    def leaves(self) -> np.ndarray:
        """Childless nodes in each subtree: pairs () between its parentheses."""
        return self._leaves[self.close] - self._leaves[self.open]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """The sum over each subtree."""
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.last + 1] - total[np.arange(len(values))]

    def minima(self, values: np.ndarray) -> np.ndarray:
        """The least value in each subtree."""
        return BlockMinima(values).over(np.arange(len(values)), self.last)

    def parents(self) -> np.ndarray:
        """The number of each node's parent, -1 for the root."""
        out = np.full(len(self.depths), -1, np.int64)
        latest = np.zeros(int(self.depths.max(initial=0)) + 1, np.int64)
        for i, d in enumerate(self.depths.tolist()):
            latest[d] = i
            if d:
                out[i] = latest[d - 1]
        return out
