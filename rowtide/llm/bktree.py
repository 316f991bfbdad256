"""BK-trees over 64-bit fingerprints, as arrays; many small trees are built and searched at once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Pairs of a probe and a node that are held at once.
FRONTIER = 2_000_000


class Trees:
    """One tree per shard. A child hangs below its parent at the edge of their Hamming distance.

    ``shard`` is sorted; the fingerprints of a shard are distinct. A shard's first is its root.
    """

    def __init__(self, shard: np.ndarray, fp: np.ndarray):
        n = len(fp)
        self.fp = fp
        self.parent = np.full(n, -1, dtype=np.int64)
        self.edge = np.zeros(n, dtype=np.int64)
        self.levels: list[np.ndarray] = []
        starts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))) if n else np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, n))
        self.root, self.size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
        items, group = np.arange(n), self.root
        while len(items):
            first = np.concatenate(([True], group[1:] != group[:-1]))
            heads, of = items[first], np.cumsum(first) - 1
            self.levels.append(heads)
            items, of = items[~first], of[~first]
            above = heads[of]
            away = np.bitwise_count(fp[items] ^ fp[above]).astype(np.int64)
            self.parent[items], self.edge[items] = above, away
            key = of * 65 + away
            order = np.argsort(key, kind="stable")
            items, group = items[order], key[order]
        below = np.flatnonzero(self.parent >= 0)
        key = self.parent[below] * 128 + self.edge[below]
        order = np.argsort(key)
        self.child, self.child_key = below[order], key[order]

    def components(self, radius: int, linked: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> np.ndarray:
        """For each node the smallest node it is linked to, directly or through others of its shard.

        Nodes within the radius are linked, if ``linked`` says so of their numbers, where given. An
        edge within the radius may be a link by itself. A subtree that has only such edges is one
        component, and a probe of that component need not enter it, so a dense cluster costs no
        more than its size.
        """
        n = len(self.fp)
        near = (self.parent >= 0) & (self.edge <= radius)
        if linked is not None:
            nodes = np.flatnonzero(near)
            near[nodes] = linked(nodes, self.parent[nodes])
        label = _settled(np.where(near, self.parent, np.arange(n)))
        mixed = np.zeros(n, dtype=bool)
        for nodes in reversed(self.levels[1:]):
            np.logical_or.at(mixed, self.parent[nodes], mixed[nodes] | ~near[nodes])
        ends = np.cumsum(self.size)
        low = 0
        while low < n:
            base = ends[low] - self.size[low]
            high = max(low + 1, int(np.searchsorted(ends, base + FRONTIER, side="right")))
            probe = np.arange(low, high)
            node = self.root[probe]
            while len(probe):
                open_ = mixed[node] | (label[node] != label[probe])
                probe, node = probe[open_], node[open_]
                away = np.bitwise_count(self.fp[probe] ^ self.fp[node]).astype(np.int64)
                hit = (away <= radius) & (label[probe] != label[node])
                if hit.any():
                    a, b = probe[hit], node[hit]
                    if linked is not None:
                        true = linked(a, b)
                        a, b = a[true], b[true]
                    label = _joined(label, label[a], label[b])
                first = np.searchsorted(self.child_key, node * 128 + np.maximum(away - radius, 0))
                last = np.searchsorted(self.child_key, node * 128 + np.minimum(away + radius, 64), side="right")
                many = last - first
                probe = np.repeat(probe, many)
                node = self.child[np.repeat(first - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(len(probe))]
            low = high
        return label


def _settled(up: np.ndarray) -> np.ndarray:
    while True:
        further = up[up]
        if np.array_equal(further, up):
            return up
        up = further


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links between the labels a and b; the smallest label of a component is its label."""
    up = np.arange(len(label))
    while True:
        ra, rb = up[a], up[b]
        if np.array_equal(ra, rb):
            return up[label]
        np.minimum.at(up, np.maximum(ra, rb), np.minimum(ra, rb))
        up = _settled(up)
