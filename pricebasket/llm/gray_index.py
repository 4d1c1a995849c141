"""A hierarchical index over 64-bit fingerprints in Gray order.

Sorted by Gray rank, neighbours differ in few bits, so a run of fingerprints
shares most of them.  Every node keeps the bits its run shares (``mask``) and
their values (``value``).  A search walks down from the roots with, per query,
the differences found so far; a node adds those among the bits that it shares
and its parent didn't, and a group whose sum exceeds the radius is dropped
whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FANOUT = 8
#: Query and node pairs held at once.
FRONTIER = 1 << 18


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each fingerprint in the reflected Gray code."""
    x = x.astype(np.uint64)
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


def bit_count(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


class GrayIndex:
    """``prints`` in Gray order; ``levels`` from the roots down to the prints
    themselves, each (mask of the bits that are new at this node, value)."""

    def __init__(self, prints: np.ndarray, fanout: int = FANOUT):
        self.order = np.argsort(gray_rank(prints), kind="stable")
        self.prints = prints[self.order]
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        ones, ors = self.prints, self.prints
        up = [(np.full(len(prints), full), self.prints)]
        while len(ones) > fanout:
            at = np.arange(0, len(ones), fanout)
            ones, ors = np.bitwise_and.reduceat(ones, at), np.bitwise_or.reduceat(ors, at)
            up.append((~(ones ^ ors), ones))
        self.fanout = fanout
        self.levels = []
        for depth in range(len(up) - 1, -1, -1):
            mask, value = up[depth]
            if depth + 1 < len(up):
                mask = mask & ~np.repeat(up[depth + 1][0], fanout)[: len(mask)]
            self.levels.append((mask, value))

    def search(self, queries: np.ndarray, radius: int, same: np.uint64 = np.uint64(0)) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query position, position in the given prints) of all pairs within
        ``radius`` that agree on the bits of ``same``, a bounded number of
        queries at a time."""
        if not len(self.prints) or not len(queries):
            return
        step = max(1, FRONTIER // 256)
        for start in range(0, len(queries), step):
            yield from self._walk(queries, np.arange(start, min(start + step, len(queries))), radius, same)

    def _walk(self, queries, chosen, radius, same):
        roots = len(self.levels[0][0])
        todo = [(0, np.repeat(chosen, roots), np.tile(np.arange(roots), len(chosen)),
                 np.zeros(len(chosen) * roots, np.uint8))]
        while todo:
            depth, q, node, far = todo.pop()
            mask, value = self.levels[depth]
            differs = (queries[q] ^ value[node]) & mask[node]
            far = far + bit_count(differs)
            near = (far <= radius) & (differs & same == 0)
            q, node, far = q[near], node[near], far[near]
            if not len(q):
                continue
            if depth + 1 == len(self.levels):
                yield q, self.order[node]
                continue
            below = len(self.levels[depth + 1][0])
            for s in range(0, len(q), FRONTIER):  # deep before wide: the frontier stays bounded
                child = node[s:s + FRONTIER, None] * self.fanout + np.arange(self.fanout)
                there = child < below
                todo.append((depth + 1, np.broadcast_to(q[s:s + FRONTIER, None], child.shape)[there], child[there],
                             np.broadcast_to(far[s:s + FRONTIER, None], child.shape)[there]))


class Forest:
    """Union-find over positions; keeps the edges that joined two trees."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            rx, ry = self.find(x), self.find(y)
            if rx != ry:
                self.parent[max(rx, ry)] = min(rx, ry)
                self.edges.append((x, y))
