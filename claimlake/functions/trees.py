"""Regression trees over binned features, as arrays: what the tasks of ``operators/forest.py`` compute on their rows.

Nothing here loads Spark. A tree is four arrays by node: the feature it splits by (-1: a leaf), the last bin that goes left, the
left child (the right one follows it) and its mean label. Rows lie in matrices of bins, one byte a feature.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np

ROWS = 1 << 17  # rows that a task works on at once
BLOCK = 256  # nodes whose sums travel as one row


def _poisson() -> np.ndarray:
    """How often a row is drawn, by 16 random bits: a bootstrap sample draws each row by Poisson(1)."""
    chances = np.cumsum(np.exp(-1.0) / np.cumprod([1, *range(1, 12)]))
    return np.searchsorted(chances, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


DRAWS = _poisson()


@dataclass
class Tree:
    feature: np.ndarray = field(default_factory=lambda: np.full(1, -1, np.int16))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(1, np.uint8))
    left: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))
    mean: np.ndarray = field(default_factory=lambda: np.zeros(1))
    slot: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))  # number of a node that may still split, else -1
    open: int = 1

    def split(self, slots: np.ndarray, feature: np.ndarray, cut: np.ndarray, counts: np.ndarray, means: np.ndarray) -> None:
        """Split the open nodes ``slots``; counts and means of the children are (left, right) by row. Children of one row stay leaves."""
        nodes = np.flatnonzero(self.slot >= 0)[slots]
        first, children = len(self.feature), 2 * len(nodes)
        self.feature[nodes], self.cut[nodes], self.left[nodes] = feature, cut, first + 2 * np.arange(len(nodes))
        grows = counts.reshape(-1) > 1
        self.open = int(grows.sum())
        self.slot = np.concatenate([np.full(first, -1, np.int32), np.where(grows, np.cumsum(grows) - 1, -1).astype(np.int32)])
        self.feature = np.concatenate([self.feature, np.full(children, -1, np.int16)])
        self.cut = np.concatenate([self.cut, np.zeros(children, np.uint8)])
        self.left = np.concatenate([self.left, np.zeros(children, np.int32)])
        self.mean = np.concatenate([self.mean, means.reshape(-1)])


def binned(values: np.ndarray, splits: Sequence[np.ndarray]) -> np.ndarray:
    """The bin of every value; bin b holds what is over split b - 1 and not over split b."""
    out = np.empty(values.shape, np.uint8)
    for n, at in enumerate(splits):
        out[:, n] = np.searchsorted(at, values[:, n])
    return out


def leaves(bins: np.ndarray, tree: Tree) -> np.ndarray:
    """The node where every row ends."""
    node = np.zeros(len(bins), np.int32)
    flat, width, at = bins.reshape(-1), bins.shape[1], np.arange(len(bins))
    here = node
    while True:
        feature = tree.feature[here]
        inner = feature >= 0
        if not inner.all():
            at, here, feature = at[inner], here[inner], feature[inner]
        if not len(at):
            return node
        here = tree.left[here] + (flat[at * width + feature] > tree.cut[here])
        node[at] = here


def drawn(keys: np.ndarray, number: int, seed: int) -> np.ndarray:
    """How often every row is drawn for a tree, whatever the partitioning: bits of the mixed key, four trees to a mix."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64((number // 4 + 1) * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return DRAWS[(x ^ (x >> np.uint64(31))) >> np.uint64(16 * (number % 4)) & np.uint64(0xFFFF)]


def cells(bins: np.ndarray, usual: np.ndarray, first: np.ndarray, total: int) -> np.ndarray:
    """The cells of each row's unusual bins, filled up with ``total``; a feature's usual bin follows from what the others leave."""
    rows, columns = np.nonzero(bins != usual)
    counts = np.bincount(rows, minlength=len(bins))
    out = np.full((len(bins), max(int(counts.max(initial=0)), 1)), total, np.int32)
    out[rows, np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)] = first[columns] + bins[rows, columns]
    return out


def level_sums(
    keys: np.ndarray, labels: np.ndarray, bins: np.ndarray, trees: Sequence[Tree], usual: np.ndarray, widths: np.ndarray, seed: int
) -> Iterator[tuple[int, int, bytes, bytes, bytes]]:
    """Per tree and block of open nodes: draws and label sums by cell, and draws, label sums and squares by node."""
    first = np.cumsum(widths) - widths
    total = int(widths.sum())
    parts = [slice(n, n + ROWS) for n in range(0, len(bins), ROWS)]
    unusual = [cells(bins[p], usual, first, total) for p in parts]
    for number, tree in enumerate(trees):
        if not tree.open:
            continue
        size = tree.open * (total + 1)
        counts, sums, whole = np.zeros(size), np.zeros(size), np.zeros((3, tree.open))
        for part, codes in zip(parts, unusual, strict=True):
            times = drawn(keys[part], number, seed)
            rows = np.flatnonzero(times > 0)
            slot = tree.slot[leaves(bins[part].take(rows, 0), tree)]
            if (slot < 0).any():
                rows, slot = rows[slot >= 0], slot[slot >= 0]
            weight = times[rows].astype(float)
            value = weight * labels[part][rows]
            for n, what in enumerate((weight, value, value * labels[part][rows])):
                whole[n] += np.bincount(slot, what, tree.open)
            cell = (slot.astype(np.int64)[:, None] * (total + 1) + codes.take(rows, 0)).reshape(-1)
            counts += np.bincount(cell, np.repeat(weight, codes.shape[1]), size)
            sums += np.bincount(cell, np.repeat(value, codes.shape[1]), size)
        counts, sums = (x.reshape(tree.open, total + 1)[:, :total] for x in (counts, sums))
        for block in range(-(-tree.open // BLOCK)):
            at = slice(block * BLOCK, (block + 1) * BLOCK)
            yield number, block, counts[at].astype(np.int32).tobytes(), sums[at].tobytes(), np.ascontiguousarray(whole[:, at]).tobytes()


def best_splits(counts: np.ndarray, sums: np.ndarray, whole: np.ndarray, usual: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, ...]:
    """For the nodes of a block: which split, their features, cuts, and the counts and means of both children.

    The split is the one that lowers the variance most, the first of equals; none if nothing lowers it. ``counts`` and ``sums`` hold
    a column a cell, those of usual bins are filled in.
    """
    draws, total, squares = whole
    best, start = np.zeros(len(draws)), 0
    feature, cut, n_left, s_left = np.full(len(draws), -1), np.zeros(len(draws), int), np.zeros(len(draws)), np.zeros(len(draws))
    nodes = np.arange(len(draws))
    before = total**2 / np.maximum(draws, 1)
    for number, width in enumerate(widths):
        at = slice(start, start + width)
        start += width
        if width < 2:
            continue
        n, s = counts[:, at].astype(float), sums[:, at].copy()
        n[:, usual[number]] = draws - n.sum(1)
        s[:, usual[number]] = total - s.sum(1)
        n, s = np.cumsum(n, 1)[:, :-1], np.cumsum(s, 1)[:, :-1]
        rest = draws[:, None] - n
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where((n > 0) & (rest > 0), s**2 / n + (total[:, None] - s) ** 2 / rest - before[:, None], 0)
        which = gain.argmax(1)
        better = gain[nodes, which] > best
        best = np.where(better, gain[nodes, which], best)
        feature, cut = np.where(better, number, feature), np.where(better, which, cut)
        n_left, s_left = np.where(better, n[nodes, which], n_left), np.where(better, s[nodes, which], s_left)
    chosen = np.flatnonzero((feature >= 0) & (best > 1e-12 * squares))
    counted = np.stack([n_left, draws - n_left], 1)[chosen]
    return chosen, feature[chosen], cut[chosen], counted, np.stack([s_left, total - s_left], 1)[chosen] / counted


def predicted(bins: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    """The mean of what the trees say."""
    out = np.zeros(len(bins))
    for tree in trees:
        out += tree.mean[leaves(bins, tree)]
    return out / len(trees)
