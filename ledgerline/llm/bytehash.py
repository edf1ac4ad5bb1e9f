"""Polynomial prefix hashes over the bytes of many texts at once (modulo 2^64, vectorised)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
#: A random value per byte, so that no byte is zero and sums do not cancel.
VALUE = np.random.default_rng(20240).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


@lru_cache(maxsize=4)
def _powers(size: int, base: int) -> np.ndarray:
    out = np.ones(size, np.uint64)
    done = 1
    while done < size:
        step = np.uint64(pow(base, done, 1 << 64))
        more = min(done, size - done)
        out[done:done + more] = out[:more] * step
        done += more
    return out


def powers(n: int, base: int = BASE) -> np.ndarray:
    """base^0 .. base^(n-1); sizes are rounded up so that few tables are built."""
    return _powers(max(1, -(-n // (1 << 18))) << 18, base)[:n]


def forget() -> None:
    """Give the tables of powers up (they are built again when needed)."""
    _powers.cache_clear()


def inverse_powers(n: int) -> np.ndarray:
    return powers(n, pow(BASE, -1, 1 << 64))


class PrefixHash:
    """Hashes of any byte ranges of ``raw`` from one running sum."""

    def __init__(self, raw: np.ndarray, value: np.ndarray = VALUE):
        self.sums = np.empty(len(raw) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(value[raw] * powers(len(raw)), out=self.sums[1:])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Hash of raw[start:stop] for each pair; equal bytes give equal hashes at any place."""
        return (self.sums[stops] - self.sums[starts]) * inverse_powers(len(self.sums))[starts]

    def fixed(self, width: int) -> np.ndarray:
        """Hash of every range of ``width`` bytes."""
        n = len(self.sums) - width
        return (self.sums[width:] - self.sums[:n]) * inverse_powers(len(self.sums))[:n] if n > 0 else np.zeros(0, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a hash over all bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def words(raw: np.ndarray, rows: np.ndarray, is_word: np.ndarray):
    """Maximal runs of word bytes inside rows (``rows``: row offsets): starts, stops, words before each row."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = is_word[raw]
    begin, end = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    cuts = rows[1:-1][(rows[1:-1] > 0) & (rows[1:-1] < len(raw))]
    begin[cuts] = inside[1:-1][cuts]
    end[cuts - 1] = inside[1:-1][cuts - 1]
    starts, stops = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, stops, np.searchsorted(starts, rows)


class Lookup:
    """Index of 64-bit keys: position of each looked-up hash in the sorted keys, or -1."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.bits = max(10, int(len(self.keys) * 16).bit_length())
        self.shift = np.uint64(64 - self.bits)
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[(self.keys >> self.shift).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places among the hashes, positions in the keys) of the hashes that are keys."""
        at = np.flatnonzero(self.maybe[(hashes >> self.shift).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        found = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        good = self.keys[found] == hashes[at]
        return at[good], found[good]
