"""Packed R-tree over points of counts, and the join of two such trees by an upper bound of the overlap.

A point has a size and, for each of some groups of elements, how many of its elements fall there. Two sets share at
most the sum over the groups of the lesser count, two boxes at most that of the lesser upper corners.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

FAN = 16  # children of a node
TOGETHER = 1 << 12  # pairs of nodes opened at a time
COMPARED = 1 << 14  # pairs of boxes compared at a time


@dataclass
class Level:
    """Boxes of one level: ranges of key and label, least size, upper corner."""

    low_key: np.ndarray
    high_key: np.ndarray
    low_label: np.ndarray
    high_label: np.ndarray
    size: np.ndarray
    counts: np.ndarray

    def __len__(self) -> int:
        return len(self.size)

    def above(self) -> Level:
        starts = np.arange(0, len(self), FAN)
        least = lambda x: np.minimum.reduceat(x, starts)
        most = lambda x: np.maximum.reduceat(x, starts)
        return Level(
            least(self.low_key), most(self.high_key), least(self.low_label), most(self.high_label), least(self.size),
            np.maximum.reduceat(self.counts, starts, axis=0),
        )


def _packed(keys: np.ndarray, labels: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Order in which runs of ``FAN`` points make small boxes: by key, then large labels by themselves, then halved
    again and again at the median of the coordinate that spreads most."""
    _, label, frequent = np.unique(labels, return_inverse=True, return_counts=True)
    apart = np.where(frequent[label] >= FAN, label, -1)
    order = np.lexsort((sizes, apart, keys))
    new = (np.diff(keys[order]) != 0) | (np.diff(apart[order]) != 0)
    edges = np.concatenate([[0], np.flatnonzero(new) + 1, [len(order)]])
    long = np.flatnonzero(np.diff(edges) > FAN)
    stack = [(int(edges[i]), int(edges[i + 1])) for i in long]
    while stack:
        start, stop = stack.pop()
        inside = order[start:stop]
        own = counts[inside]
        axis = int((own.max(axis=0) - own.min(axis=0)).argmax())
        order[start:stop] = inside[np.argsort(own[:, axis], kind="stable")]
        middle = start + -(-(stop - start) // (2 * FAN)) * FAN
        stack += [(a, b) for a, b in ((start, middle), (middle, stop)) if b - a > FAN]
    return order


class CountTree:
    """R-tree over points; points with different keys or equal labels are never paired."""

    def __init__(self, keys: np.ndarray, labels: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> None:
        self.order = _packed(keys, labels, sizes, counts)
        keys, labels, sizes, counts = (x[self.order] for x in (keys, labels, sizes, counts))
        self.levels = [Level(keys, keys, labels, labels, sizes, counts)]
        while len(self.levels[-1]) > 1:
            self.levels.append(self.levels[-1].above())

    def level(self, k: int) -> Level:
        """Level ``k`` from the points up; the root stands for all levels above it."""
        return self.levels[min(k, len(self.levels) - 1)]

    def children(self, k: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nodes of level ``k`` below some of level ``k + 1``, and which of the latter each belongs to."""
        if k + 1 > len(self.levels) - 1:
            return nodes, np.arange(len(nodes))
        below = nodes[:, None] * FAN + np.arange(FAN)
        real = below < len(self.levels[k])
        return below[real], np.nonzero(real)[0]


def _may_overlap(a: Level, b: Level, i: np.ndarray, j: np.ndarray, per_cent: int) -> np.ndarray:
    """Which pairs of boxes may hold sets that share ``per_cent`` of their union."""
    found = (a.low_key[i] <= b.high_key[j]) & (b.low_key[j] <= a.high_key[i])
    one = (a.low_label[i] == a.high_label[i]) & (b.low_label[j] == b.high_label[j])
    found &= ~(one & (a.low_label[i] == b.low_label[j]))
    left = np.flatnonzero(found)
    for start in range(0, len(left), COMPARED):
        some = left[start : start + COMPARED]
        shared = np.minimum(a.counts[i[some]], b.counts[j[some]]).sum(axis=1, dtype=np.int64)
        found[some] = (100 + per_cent) * shared >= per_cent * (a.size[i[some]] + b.size[j[some]])
    return found


def joined(a: CountTree, b: CountTree, per_cent: int) -> tuple[np.ndarray, np.ndarray]:
    """Points of ``a`` and of ``b`` with one key, different labels and counts that let them be similar enough."""
    top = max(len(a.levels), len(b.levels)) - 1
    root = np.zeros(1, np.int64)
    stack, left, right = [(top, root, root)], [], []
    while stack:
        k, i, j = stack.pop()
        if len(i) > TOGETHER:
            half = len(i) // 2
            stack += [(k, i[:half], j[:half]), (k, i[half:], j[half:])]
            continue
        near = _may_overlap(a.level(k), b.level(k), i, j, per_cent)
        i, j = i[near], j[near]
        if not k:
            left.append(a.order[i])
            right.append(b.order[j])
            continue
        if len(i):
            i, owner = a.children(k - 1, i)
            j, pair = b.children(k - 1, j[owner])
            stack.append((k - 1, i[pair], j))
    return np.concatenate(left or [root[:0]]), np.concatenate(right or [root[:0]])
