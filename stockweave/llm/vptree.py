"""Vantage-point partitioning of 64-bit words by Hamming distance.

A tree over whole 64-bit words prunes little: distances of unrelated words
gather around 32, so a radius of 4 reaches across nearly every boundary. By the
pigeonhole principle two words within ``r`` bits agree within ``r // 3`` bits on
one of three segments, and on a segment of 21 bits a radius of 1 crosses few
boundaries. So each segment has a vantage-point tree under its own Hamming
distance, and pairs that meet in a leaf are tested on all 64 bits.

A node sends words nearer to its vantage point than ``mu`` to the left. The
triangle inequality bounds how far a partner may lie: a pair within ``r`` that
straddles the boundary has its left end at ``mu - r`` or more. Only those words
are copied to the right, so every pair meets in a leaf and nothing is copied
both ways.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SEGMENTS = (
    np.uint64((1 << 22) - 1),
    np.uint64(((1 << 21) - 1) << 22),
    np.uint64(((1 << 21) - 1) << 43),
)

# Splits that would not shrink both sides by this power of their size are not made.
COST_POWER = 1.3
VANTAGE_POINTS_TRIED = 6


@dataclass(frozen=True)
class Tree:
    """Arrays by node. A child of -1 - k is leaf k; ``radius`` holds on the segment."""

    mask: np.uint64
    radius: int
    vantage: np.ndarray
    mu: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaves: int

    def route(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the word, leaf) for the home of every word and its copies."""
        if not len(self.mu):
            return np.arange(len(words)), np.zeros(len(words), dtype=np.int64)
        own = words & self.mask
        index, leaf = [], []
        todo = [(0, np.arange(len(words)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            if node < 0:
                index.append(at)
                leaf.append(np.full(len(at), -1 - node, dtype=np.int64))
                continue
            d = np.bitwise_count(own[at] ^ self.vantage[node])
            mu = int(self.mu[node])
            todo.append((int(self.left[node]), at[d < mu]))
            todo.append((int(self.right[node]), at[d >= mu - self.radius]))
        if not index:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(index), np.concatenate(leaf)


def _best_split(own: np.ndarray, radius: int, rng) -> tuple[float, np.uint64, int]:
    best = (1.0, np.uint64(0), 0)
    for v in own[rng.integers(0, len(own), VANTAGE_POINTS_TRIED)]:
        seen = np.bincount(np.bitwise_count(own ^ v), minlength=66) / len(own)
        below = np.concatenate([[0.0], np.cumsum(seen)])  # share with distance < mu
        for mu in range(radius + 1, 65):
            left, right = below[mu], 1.0 - below[mu - radius]
            if left <= 0.0 or right <= 1e-9:
                continue
            cost = left**COST_POWER + right**COST_POWER
            if cost < best[0]:
                best = (cost, v, mu)
    return best


def build_tree(
    sample: np.ndarray, total: int, leaf_size: int, mask: np.uint64, radius: int
) -> Tree:
    """A tree over a sample of ``total`` words whose leaves should hold ``leaf_size``.

    The tree decides only where words meet, never which pairs are found, so a
    sample is enough. It is bounded by the sample: a leaf keeps 8 of its words.
    """
    rng = np.random.default_rng(17)
    scale = max(1.0, total / max(1, len(sample)))
    vantage, mu, left, right = [], [], [], []
    leaves = 0

    def grow(own: np.ndarray) -> int:
        nonlocal leaves
        if len(own) >= 16 and len(own) * scale > leaf_size:
            cost, v, m = _best_split(own, radius, rng)
            if cost < 0.995:
                node = len(mu)
                vantage.append(v)
                mu.append(m)
                left.append(0)
                right.append(0)
                d = np.bitwise_count(own ^ v)
                left[node] = grow(own[d < m])
                right[node] = grow(own[d >= m - radius])
                return node
        leaves += 1
        return -leaves

    grow(sample & mask)
    return Tree(
        mask,
        radius,
        np.array(vantage, dtype=np.uint64),
        np.array(mu, dtype=np.int64),
        np.array(left, dtype=np.int64),
        np.array(right, dtype=np.int64),
        leaves,
    )


def spanning_links(words: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(child, root) of a star for each group of distinct words linked within ``radius``.

    A search that drops every word it reaches: linear output, and in a dense
    group the words left to compare vanish after a few steps.
    """
    left = np.unique(words)
    child, root = [], []
    while len(left) > 1:
        first, left = left[0], left[1:]
        todo = [first]
        while todo and len(left):
            near = np.bitwise_count(left ^ todo.pop()) <= radius
            if near.any():
                hits = left[near]
                left = left[~near]
                child.append(hits)
                root.append(np.full(len(hits), first, dtype=np.uint64))
                todo.extend(hits)
    if not child:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    return np.concatenate(child), np.concatenate(root)
