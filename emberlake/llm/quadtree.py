"""K-squared tree of a sparse matrix of counts, and the distance of each pair of its rows.

The matrix is cut into quadrants again and again; only nonzero quadrants have nodes. Each node is four bits, one per
quadrant, and the number of ones before a bit is the place of the child's node in the next level. Two rows are
compared by walking the tree with two nodes side by side, over the same columns.
"""

from __future__ import annotations

import numpy as np

TOGETHER = 1 << 16  # pairs of nodes walked at a time: what bounds a task's memory, whatever the matrix
#: Half of the rows of the one node, of the other node, and of the columns.
HALVES = np.array([(a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1)], np.int64)


class QuadTree:
    """Nonzero cells (row, column) of a square matrix of side ``2 ** height``, as levels of quadrant bits."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, height: int) -> None:
        self.height = height
        code = np.zeros(len(rows), np.int64)
        for bit in range(height):
            code |= (((rows >> bit) & 1) << (2 * bit + 1)) | (((columns >> bit) & 1) << (2 * bit))
        self.order = np.argsort(code)  # of the cells as leaves
        self.levels: list[np.ndarray] = []  # from the root down: place of each quadrant's node, -1 for a zero quadrant
        nodes = code[self.order]
        while len(self.levels) < height:
            above, owner = np.unique(nodes >> 2, return_inverse=True)
            bits = np.zeros(4 * len(above), bool)
            bits[4 * owner + (nodes & 3)] = True
            self.levels.append(np.where(bits, np.cumsum(bits) - 1, -1))
            nodes = above
        self.levels.reverse()

    def children(self, level: int, nodes: np.ndarray, quadrants: np.ndarray) -> np.ndarray:
        """Place in the next level of a quadrant of each node; -1 for a zero quadrant and below one."""
        below = self.levels[level]
        return np.where(nodes >= 0, below[np.where(nodes >= 0, 4 * nodes + quadrants, 0)], -1)


def row_distances(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, absent: np.ndarray, n_columns: int, split: int = 0
) -> np.ndarray:
    """Sum over the columns of the absolute differences of two rows' values, for each pair a < b of rows.

    ``values`` stand at (``rows``, ``columns``), each cell once; row ``a`` has ``absent[a]`` in all other cells. Whole
    numbers throughout. Where both nodes are zero quadrants their width is all that counts: it is added up and priced
    at the end with the difference of the absent values. With ``split`` only pairs of a row below it with one from it
    on are compared; it is a power of two.
    """
    n = len(absent)
    total = np.zeros((n, n), np.int64)
    side = max(n, n_columns, 1)
    height = int(side - 1).bit_length()
    if not len(rows):
        return _priced(total, np.full((n, n), n_columns, np.int64), absent)
    tree = QuadTree(rows, columns, height)
    leaves = values[tree.order]
    empty = [np.zeros((-(-n >> (height - k)),) * 2, np.int64) for k in range(height + 1)]  # columns, by ranges of rows
    first = np.zeros(1, np.int64)
    stack = [(0, first, first, first, first, first)]  # level, the two nodes, their rows' ranges, the columns' range
    while stack:
        level, a, b, ra, rb, c = stack.pop()
        if len(a) > TOGETHER:
            half = len(a) // 2
            stack += [(level, *(x[:half] for x in (a, b, ra, rb, c))), (level, *(x[half:] for x in (a, b, ra, rb, c)))]
            continue
        size = 1 << (height - level)
        neither = (a < 0) & (b < 0)
        width = np.minimum((c[neither] + 1) * size, n_columns) - c[neither] * size
        np.add.at(empty[level], (ra[neither], rb[neither]), width)
        a, b, ra, rb, c = (x[~neither] for x in (a, b, ra, rb, c))
        if not len(a):
            continue
        if level == height:
            one = np.where(a >= 0, leaves[a], absent[ra])
            two = np.where(b >= 0, leaves[b], absent[rb])
            np.add.at(total, (ra, rb), np.abs(one - two))
            continue
        ha, hb, hc = (np.tile(h, len(a)) for h in HALVES.T)
        a, b, ra, rb, c = (np.repeat(x, len(HALVES)) for x in (a, b, ra, rb, c))
        size >>= 1
        a, b = tree.children(level, a, 2 * ha + hc), tree.children(level, b, 2 * hb + hc)
        ra, rb, c = 2 * ra + ha, 2 * rb + hb, 2 * c + hc
        stay = (ra <= rb) & (rb * size < n) & (c * size < n_columns)
        if size == 1:
            stay &= ra < rb
        if split and size <= split:
            stay &= (ra * size < split) & (rb * size >= split)
        stack.append((level + 1, *(x[stay] for x in (a, b, ra, rb, c))))
    blank = np.zeros((n, n), np.int64)
    for level, width in enumerate(empty):
        size = 1 << (height - level)
        blank += np.repeat(np.repeat(width, size, axis=0), size, axis=1)[:n, :n]
    return _priced(total, blank, absent)


def _priced(total: np.ndarray, blank: np.ndarray, absent: np.ndarray) -> np.ndarray:
    return total + blank * np.abs(absent[:, None] - absent[None, :])
