"""Byte-pair merges of many words at once, on flat numpy arrays.

Each round finds every word's lowest pair rank, merges that pair wherever it stands in the word
(leftmost first where occurrences overlap), closes the gaps and looks up the pairs that changed.
Words without a pair leave.  A pair whose result takes part in a pair of lower rank merges only at
its leftmost place in a round, since that place decides what follows; so the result is that of
merging one pair at a time, lowest rank and leftmost first.
"""

from __future__ import annotations

import numpy as np

NONE = np.int32(2**31 - 1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """(left, right) -> rank and merged symbol, in an open-addressing table."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray, rank: np.ndarray):
        left, right, merged, rank = (np.asarray(x, np.int64) for x in (left, right, merged, rank))
        self.merged = np.zeros(int(rank.max(initial=0)) + 1, np.int64)  # pairs of one rank give one symbol
        self.merged[rank] = merged
        least = np.full(int(max(merged.max(initial=0), left.max(initial=0), right.max(initial=0))) + 1, NONE, np.int64)
        np.minimum.at(least, left, rank)
        np.minimum.at(least, right, rank)
        self.alone = least[self.merged] <= np.arange(len(self.merged))
        bits = max(8, int(4 * len(left)).bit_length())
        self.shift, self.size = np.uint64(64 - bits), 1 << bits
        self.keys = np.full(self.size, -1, np.int64)
        self.ranks = np.full(self.size, NONE, np.int32)
        keys = self._key(left, right)
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[at[todo]] == -1
            self.keys[at[todo[free]]] = keys[todo[free]]
            placed = self.keys[at[todo]] == keys[todo]
            self.ranks[at[todo[placed]]] = rank[todo[placed]]
            todo = todo[~placed]
            at[todo] = (at[todo] + 1) & (self.size - 1)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left << 32) | right

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or NONE."""
        keys = self._key(left, right)
        at = self._slot(keys)
        out = self.ranks[at]
        held = self.keys[at]
        out[held != keys] = NONE
        todo = np.flatnonzero((held != keys) & (held != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & (self.size - 1)
            held = self.keys[at[todo]]
            good = held == keys[todo]
            out[todo[good]] = self.ranks[at[todo[good]]]
            todo = todo[~good & (held != -1)]
        return out


def merge(symbols: np.ndarray, lengths: np.ndarray, pairs: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Surviving symbols of all words, and how many each word has.  Symbols under 0 never merge."""
    total = len(lengths)
    word = np.repeat(np.arange(total), lengths)
    symbols = symbols.astype(np.int64)
    done_words, done_symbols = [], []

    def ranks(at: np.ndarray) -> np.ndarray:
        """Rank of the pair that starts at each place."""
        out = np.full(len(at), NONE, np.int32)
        inner = at[at + 1 < len(word)]
        ok = np.flatnonzero((word[inner] == word[inner + 1]) & (symbols[inner] >= 0) & (symbols[inner + 1] >= 0))
        out[ok] = pairs.find(symbols[inner[ok]], symbols[inner[ok] + 1])
        return out

    rank = ranks(np.arange(len(word)))
    while len(word):
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        sizes = np.diff(np.r_[starts, len(word)])
        least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
        active = least != NONE
        if not active.all():
            done_words.append(word[~active])
            done_symbols.append(symbols[~active])
            word, symbols, rank, least = word[active], symbols[active], rank[active], least[active]
            if not len(word):
                break
        lowest = rank == least
        place = np.arange(len(word))
        run = np.maximum.accumulate(np.where(lowest & ~np.r_[False, lowest[:-1]], place, 0))
        at = np.flatnonzero(lowest & ((place - run) % 2 == 0))
        one = pairs.alone[rank[at]]
        if one.any():
            at = at[~one | np.r_[True, word[at][1:] != word[at][:-1]]]
        symbols[at] = pairs.merged[rank[at]]
        stay = np.ones(len(word), bool)
        stay[at + 1] = False
        at = at - np.arange(len(at))  # as many gaps were closed before each
        word, symbols, rank = word[stay], symbols[stay], rank[stay]
        touched = np.zeros(len(word), bool)
        touched[at] = touched[np.maximum(at - 1, 0)] = True
        changed = np.flatnonzero(touched)
        rank[changed] = ranks(changed)
    if not done_words:
        return symbols[:0], np.zeros(total, np.int64)
    word, symbols = np.concatenate(done_words), np.concatenate(done_symbols)
    return symbols[np.argsort(word, kind="stable")], np.bincount(word, minlength=total)
