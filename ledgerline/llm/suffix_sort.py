"""Mergesort of suffixes compared by prefix hashes.

The common extension of two suffixes is found by binary search over its length with polynomial prefix
hashes, so a comparison takes a logarithmic number of steps.  Runs are merged bottom-up for all groups
at once: each item's place is its place in its own run plus its rank, by binary search, in the other.
Neighbours in the result are then compared byte by byte; a group in which a hash deceived is sorted
again by its bytes.
"""

from __future__ import annotations

import numpy as np

from . import bytehash


class Suffixes:
    """Suffixes of ``raw`` cut at ``depth`` bytes; every start has that many bytes behind it."""

    def __init__(self, raw: np.ndarray, depth: int, value: np.ndarray = bytehash.VALUE):
        self.raw, self.depth = raw, depth
        self.sums = bytehash.PrefixHash(raw, value).sums
        self.back = bytehash.inverse_powers(len(self.sums))

    def windows(self, starts: np.ndarray) -> np.ndarray:
        """Hash of the whole suffix at each start."""
        return (self.sums[starts + self.depth] - self.sums[starts]) * self.back[starts]

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common extension of each pair of suffixes, at most the depth."""
        same = np.zeros(len(i), np.int64)
        whole = self._equal(i, j, np.full(len(i), self.depth))
        same[whole] = self.depth
        todo = np.flatnonzero(~whole)
        a, b = i[todo], j[todo]
        low, high = np.zeros(len(todo), np.int64), np.full(len(todo), self.depth - 1)
        for _ in range(int(self.depth - 1).bit_length()):
            middle = (low + high + 1) >> 1
            equal = self._equal(a, b, middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        same[todo] = low
        return same

    def _equal(self, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[i + size] - self.sums[i]) * self.back[i] == (self.sums[j + size] - self.sums[j]) * self.back[j]

    def before(self, i: np.ndarray, j: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix i sorts before suffix j (or equals it, where that is asked for)."""
        same = self.extension(i, j)
        equal = same == self.depth
        at = np.minimum(same, self.depth - 1)
        return np.where(equal, or_equal, self.raw[i + at] < self.raw[j + at])

    def sort(self, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order that sorts the suffixes inside each group; groups are consecutive and stay in place."""
        n = len(starts)
        order = np.arange(n)
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, int)
        size = np.diff(np.r_[first, n])
        base, end = np.repeat(first, size), np.repeat(first + size, size)
        width = 1
        while len(size) and width < size.max():
            item = np.flatnonzero(end - base > width)
            offset = item - base[item]
            run = base[item] + offset // width * width
            left = (offset // width) % 2 == 0
            other = np.where(left, run + width, run - width)
            stop = np.minimum(other + width, end[item])
            some = other < stop
            item, run, left, other, stop = item[some], run[some], left[some], other[some], stop[some]
            low, high = other.copy(), stop.copy()  # how many of the other run go before the item
            open_ = np.flatnonzero(low < high)
            while len(open_):
                middle = (low[open_] + high[open_]) >> 1
                less = self.before(starts[order[middle]], starts[order[item[open_]]], ~left[open_])
                low[open_] = np.where(less, middle + 1, low[open_])
                high[open_] = np.where(less, high[open_], middle)
                open_ = open_[low[open_] < high[open_]]
            place = np.minimum(run, other) + (item - run) + (low - other)
            merged = order.copy()
            merged[place] = order[item]
            order = merged
            width *= 2
        return order

    def classes(self, starts: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, class): items in sorted order and, in that order, numbers that are equal for equal
        suffixes of a group.  Every neighbouring pair is checked against the bytes."""
        order = self.sort(starts, group)
        if not len(order):
            return order, order
        views = np.lib.stride_tricks.sliding_window_view(self.raw, self.depth)
        new = np.ones(len(order), bool)
        bad = np.zeros(len(order), bool)
        for at in range(1, len(order), 1 << 15):
            k = np.arange(at, min(at + (1 << 15), len(order)))
            k = k[group[k] == group[k - 1]]
            i, j = starts[order[k - 1]], starts[order[k]]
            differ = views[i] != views[j]
            true = np.where(differ.any(1), differ.argmax(1), self.depth)
            at_byte = np.minimum(true, self.depth - 1)
            bad[k] = (self.extension(i, j) != true) | ((true < self.depth) & (self.raw[i + at_byte] > self.raw[j + at_byte]))
            new[k] = true < self.depth
        for g in np.unique(group[bad]):
            a, b = np.searchsorted(group, g), np.searchsorted(group, g, side="right")
            text = [self.raw[s:s + self.depth].tobytes() for s in starts[a:b].tolist()]
            again = sorted(range(b - a), key=text.__getitem__)
            order[a:b] = a + np.array(again)
            new[a + 1:b] = [text[x] != text[y] for x, y in zip(again, again[1:])]
        return order, np.cumsum(new) - 1
