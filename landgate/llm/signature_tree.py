"""Signature trees over sets of 64-bit numbers, and their dual traversal.

A leaf is a set with its bitmap: bit (number modulo bits) for each number. A node above holds the OR of its
children's bitmaps, the range of their sizes and their largest excess (numbers beyond one for each bit).
Two sets below nodes a and b share at most as many numbers as both bitmaps share bits, plus the smaller of
the excesses, and at most as many as the smaller has. A pair of nodes goes on to its children only if that
would be enough for some pair of sizes below it.

What is asked for are the connected groups of similar sets, so pairs already connected are passed over: a
node whose sets are all in one group need not meet another such node of the same group.
"""

from __future__ import annotations

import numpy as np

FANOUT = 8
MIN_BITS, MAX_BITS = 256, 1 << 16
#: 64-bit words of bitmaps compared at once.
AT_ONCE = 1 << 20
#: Two sets are similar if 100 * shared >= PERCENT * size of the union.
PERCENT = 75


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """``a`` and ``b`` are sorted and hold no number twice."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared) and shared > 0


class Groups:
    """Union-find over 0..n-1."""

    def __init__(self, start: list[int]):
        first: dict[int, int] = {}
        self.parent = [first.setdefault(key, i) for i, key in enumerate(start)]

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j

    def roots(self) -> np.ndarray:
        return np.array([self.find(i) for i in range(len(self.parent))], np.int64)


class Tree:
    """Levels of nodes over the given sets, in their order: levels[0] are the sets."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        words, n = bits // 64, len(sets)
        size = np.array([len(s) for s in sets], np.int64)
        bitmap, mark = np.zeros((n, words), np.uint64), np.zeros(bits, bool)
        for i, own in enumerate(sets):
            mark[(own % np.uint64(bits)).astype(np.int64)] = True
            bitmap[i] = np.packbits(mark).view(np.uint64)
            mark[:] = False
        excess = size - np.bitwise_count(bitmap).sum(axis=1, dtype=np.int64)
        self.levels = [(bitmap, size, size, excess)]
        while len(bitmap) > 1:
            cut = np.arange(0, len(bitmap), FANOUT)
            bitmap = np.bitwise_or.reduceat(bitmap, cut, axis=0)
            _, low, high, excess = self.levels[-1]
            low, high = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            self.levels.append((bitmap, low, high, np.maximum.reduceat(excess, cut)))
            excess = self.levels[-1][3]


def one_group(groups: np.ndarray, level: int) -> np.ndarray:
    """For each node of a level its sets' group if that is one, else -1."""
    for _ in range(level):
        cut = np.arange(0, len(groups), FANOUT)
        low, high = np.minimum.reduceat(groups, cut), np.maximum.reduceat(groups, cut)
        groups = np.where(low == high, low, -1)
    return groups


def possible(a_level: tuple, b_level: tuple, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the node pairs (a[i], b[i]) may hold a similar pair of sets."""
    (a_bits, a_low, a_high, a_more), (b_bits, b_low, b_high, b_more) = a_level, b_level
    fits = (100 * a_high[a] >= PERCENT * b_low[b]) & (100 * b_high[b] >= PERCENT * a_low[a])
    at = np.flatnonzero(fits)
    step = max(1, AT_ONCE // a_bits.shape[1])
    for i in range(0, len(at), step):
        some = at[i : i + step]
        x, y = a[some], b[some]
        shared = np.bitwise_count(a_bits[x] & b_bits[y]).sum(axis=1, dtype=np.int64)
        most = np.minimum(shared + np.minimum(a_more[x], b_more[y]), np.minimum(a_high[x], b_high[y]))
        fits[some] = (100 + PERCENT) * most >= PERCENT * (a_low[x] + b_low[y])
    return fits


def _children(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, same: bool):
    k = np.arange(FANOUT)
    x = np.repeat(a[:, None] * FANOUT + k, FANOUT, axis=1).ravel()
    y = np.tile(b[:, None] * FANOUT + k, (1, FANOUT)).ravel()
    kept = (x < n_a) & (y < n_b)
    if same:
        kept &= x <= y
    return x[kept], y[kept]


def links(
    sets: list[np.ndarray],
    known: list[int] | None = None,
    others: list[np.ndarray] | None = None,
    others_known: list[int] | None = None,
) -> list[tuple[int, int]]:
    """Pairs (i, j) of similar sets that connect all groups which similar pairs make.

    ``known`` are groups known before, equal keys for connected sets. With ``others`` only pairs of a set
    and one of the others are looked for; these are numbered after the sets.
    """
    n = len(sets)
    if not n or (others is not None and not len(others)):
        return []
    same = others is None
    everything = sets if same else [*sets, *others]
    keys = list(range(len(everything)))
    if known is not None:
        keys = [*known, *(others_known or [])]
    groups = Groups(keys)
    most = max(len(s) for s in everything)
    bits = min(MAX_BITS, max(MIN_BITS, 1 << int(4 * most).bit_length()))

    def ordered(numbers: list[int]) -> np.ndarray:
        return np.array(sorted(numbers, key=lambda i: (everything[i][0], len(everything[i]), i)), np.int64)

    left = ordered(list(range(n)))
    right = left if same else ordered(list(range(n, len(everything))))
    found: list[tuple[int, int]] = []

    def tried(i: int, j: int) -> None:
        if groups.find(i) != groups.find(j) and similar(everything[i], everything[j]):
            groups.join(i, j)
            found.append((i, j))

    if same:  # sets with the same smallest number lie side by side; connecting these first prunes most
        for i, j in zip(left[:-1].tolist(), left[1:].tolist(), strict=True):
            if everything[i][0] == everything[j][0]:
                tried(i, j)
    a_tree = Tree([everything[i] for i in left], bits)
    b_tree = a_tree if same else Tree([everything[i] for i in right], bits)
    while len(a_tree.levels) < len(b_tree.levels):
        a_tree.levels.append(a_tree.levels[-1])
    while len(b_tree.levels) < len(a_tree.levels):
        b_tree.levels.append(b_tree.levels[-1])
    a = b = np.zeros(1, np.int64)
    for level in range(len(a_tree.levels) - 1, -1, -1):
        roots = groups.roots()
        a_own = one_group(roots[left], level)
        b_own = one_group(roots[right], level)
        a_own, b_own = a_own[a], b_own[b]
        new = ~((a_own >= 0) & (a_own == b_own))
        a, b = a[new], b[new]
        fits = possible(a_tree.levels[level], b_tree.levels[level], a, b)
        a, b = a[fits], b[fits]
        if level:
            a, b = _children(a, b, len(a_tree.levels[level - 1][1]), len(b_tree.levels[level - 1][1]), same)
    for i, j in zip(left[a].tolist(), right[b].tolist(), strict=True):
        tried(i, j)
    return found
