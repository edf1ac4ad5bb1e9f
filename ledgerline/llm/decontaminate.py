"""Benchmark decontamination as a prefix-filtered set join.

Words: A-Z made lower case, then ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  A window is ten consecutive
words of an item; an item of fewer words (not none) is one window.  A window's set is its shingles of
two words (one word: that word).  Full containment of the set needs a prefix of one shingle in the
order of rarity, so the join looks up each window's rarest shingle only, counted over all documents.
A candidate must pass the positional and length bounds (the window fits into the document where the
shingle stands), then the hashes of all its words, then a comparison of the bytes themselves.

The benchmark is the bounded side: it is cut into blocks of at most about ``BLOCK_BYTES`` of text,
each block is broadcast alone, and with more than one block the documents with their marks so far
are written between blocks.  A block's index is flat arrays over the block's words: measured, 11 bytes a
byte of text when sent, 31 held in a worker, 53 at the peak of building it on the driver.  Documents
are never shuffled.  Null or empty texts have no words; items without words have no windows; item ids are compared as text; null item ids count for hits
but are not listed; repeated items count once; documents are handled row by row; input columns may have
any names but those of the results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytehash
from .common import fresh, held, refuse, slices, stored, utf8

WINDOW = 10
BLOCK_BYTES = 4 << 20
#: Bytes of text handled at once in a worker.
AT_ONCE = 2 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[ord("0"):ord("9") + 1] = IS_WORD[ord("a"):ord("z") + 1] = IS_WORD[128:] = True

RESULTS = ["_n_words", "_n_hit", "_n_items", "_items_sha256"]


class Words:
    """Words of many rows: bytes, bounds, hashes, and the number of words before each row."""

    def __init__(self, column: pa.Array):
        raw, rows = utf8(column)
        self.raw = LOWER[raw]
        self.starts, self.stops, self.rows = bytehash.words(self.raw, rows, IS_WORD)
        self.hash = bytehash.mix(bytehash.PrefixHash(self.raw).of(self.starts, self.stops))

    def pairs(self) -> np.ndarray:
        """Hash of each word with the next (the last one of all alone); pairs over rows match no window."""
        return pair_hash(self.hash[:-1], self.hash[1:]) if len(self.hash) else self.hash

    def bytes(self, at: int) -> bytes:
        return self.raw[self.starts[at]:self.stops[at]].tobytes()


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return bytehash.mix(a * np.uint64(3) + b)


def runs(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (count[0] of them), first[1], ..."""
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())


class Index:
    """Distinct windows of a block of items, in flat arrays: each is a run of words of the block's text."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        words = Words(pa.array([t or "" for _, t in items], pa.large_string()))
        own = np.diff(words.rows)
        many = np.where(own > 0, np.maximum(own - window + 1, 1), 0)
        first, size = runs(words.rows[:-1], many), np.repeat(np.minimum(own, window), many)
        item = np.repeat(np.arange(len(items)), many)
        # equal windows: two hashes of their words (128 bits)
        key = [self._hashes(words.hash, first, size), self._hashes(bytehash.mix(~words.hash), first, size)]
        order = np.lexsort((first, key[1], key[0], size))
        new = np.ones(len(order), bool)
        if len(order):
            same = (size[order][1:] == size[order][:-1])
            for k in key:
                same &= k[order][1:] == k[order][:-1]
            new[1:] = ~same
        self.first, self.size = first[order][new], size[order][new].astype(np.int16)
        self.raw, self.starts, self.stops, self.hash = words.raw, words.starts, words.stops, words.hash
        #: names of the items, and which of them each window has (ragged)
        names = sorted({i for i, _ in items if i is not None})
        at = {n: k for k, n in enumerate(names)}
        named = np.array([at.get(i, -1) for i, _ in items], np.int32)[item[order]] if len(order) else np.zeros(0, np.int32)
        pairs = np.unique(np.stack([np.cumsum(new) - 1, named], 1)[named >= 0], axis=0)
        self.names, self.listed = names, pairs[:, 1].astype(np.int32)
        self.list_at = np.searchsorted(pairs[:, 0], np.arange(len(self.first) + 1))
        self.alone = self.size == 1

    @staticmethod
    def _hashes(word: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word * bytehash.powers(len(word)))])
        return bytehash.mix((sums[first + size] - sums[first]) * bytehash.inverse_powers(len(sums))[first])

    def items(self, window: int) -> np.ndarray:
        return self.listed[self.list_at[window]:self.list_at[window + 1]]

    def _pairs(self) -> np.ndarray:
        """Shingle at every word of the block: with the next word (the last word: by itself)."""
        return np.concatenate([pair_hash(self.hash[:-1], self.hash[1:]), self.hash[-1:]])

    def shingles(self) -> np.ndarray:
        """All shingles of the windows; those of one word are that word."""
        inside = self.first[~self.alone]
        places = np.unique((inside[:, None] + np.arange(int(self.size.max(initial=2)) - 1)).ravel()) if len(inside) else inside
        return np.unique(np.concatenate([self._pairs()[places[places < len(self.hash)]], self.hash[self.first[self.alone]]]))

    def rarest(self, keys: np.ndarray, counts: np.ndarray) -> "Index":
        """Keep the necessary prefix of each window: its rarest shingle (ties: smaller hash, then offset)."""
        pairs = self._pairs() if len(self.hash) else self.hash
        at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
        count = np.where(keys[at] == pairs, counts[at], 0) if len(keys) else np.zeros(len(pairs), np.int64)
        best = self.first.copy()
        for k in range(1, int(self.size.max(initial=0)) - 1):
            some = np.flatnonzero(self.size > k + 1)
            new, old = self.first[some] + k, best[some]
            less = (count[new] < count[old]) | ((count[new] == count[old]) & (pairs[new] < pairs[old]))
            best[some[less]] = new[less]
        shingle = np.where(self.alone, self.hash[self.first], pairs[best]) if len(best) else self.hash[:0]
        order = np.argsort(shingle, kind="stable")
        self.window, self.shingle = order.astype(np.int32), shingle[order]
        self.offset = (best - self.first)[order].astype(np.int16)
        return self


def counted(docs: DataFrame, text: str, keys: np.ndarray, alone: bool) -> np.ndarray:
    """How often each shingle of the block occurs in all documents; as many results as shingles at most."""
    shared = docs.sparkSession.sparkContext.broadcast(keys)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("decontaminate", dict)
        look = bytehash.Lookup(shared.value)
        total = np.zeros(len(look.keys), np.int64)
        for batch in batches:
            for part in slices(batch, "t", AT_ONCE):
                words = Words(part.column(0))
                for hashes in (words.pairs(), words.hash) if alone else (words.pairs(),):
                    total += np.bincount(look.find(hashes)[1], minlength=len(look.keys))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"k": some, "n": total[some]})

    rows = docs.select(F.col(text).alias("t")).mapInArrow(each, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(keys), np.int64)
    out[rows.column("k").to_numpy()] = rows.column("n").to_numpy()
    shared.unpersist()
    return out


def _equal_words(words: Words, at: np.ndarray, index: Index, place: np.ndarray) -> np.ndarray:
    """Whether word at[i] of the texts has the bytes of word place[i] of the block."""
    a, b = words.starts[at], index.starts[place]
    size = words.stops[at] - a
    same = size == index.stops[place] - b
    if same.any():
        n = size[same]
        differ = words.raw[runs(a[same], n)] != index.raw[runs(b[same], n)]
        same[same] = ~np.logical_or.reduceat(differ, np.cumsum(n) - n)
    return same


def _mark(index: Index, look: bytehash.Lookup, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, window, row) of every verified occurrence."""
    first, last = np.searchsorted(index.shingle, look.keys), np.searchsorted(index.shingle, look.keys, side="right")
    starts, windows = [], []
    for alone, hashes in ((False, words.pairs()), (True, words.hash)):
        at, key = look.find(hashes)
        many = (last - first)[key]
        entry = runs(first[key], many)
        fits = index.alone[index.window[entry]] == alone
        starts.append(np.repeat(at, many)[fits] - index.offset[entry[fits]])
        windows.append(index.window[entry[fits]])
    start, window = np.concatenate(starts), np.concatenate(windows)
    row = np.searchsorted(words.rows, start, side="right") - 1
    good = (start >= 0) & (row >= 0)
    good[good] = start[good] + index.size[window[good]] <= words.rows[row[good] + 1]
    start, window, row = start[good], window[good], row[good]
    for check in (lambda at, place: words.hash[at] == index.hash[place], lambda at, place: _equal_words(words, at, index, place)):
        for i in range(int(index.size.max(initial=0))):
            has = i < index.size[window]
            same = ~has
            same[has] = check(start[has] + i, index.first[window[has]] + i)
            start, window, row = start[same], window[same], row[same]
    return start, window, row


def _marker(shared, last: bool):
    """Arrow function: texts (and marks so far) to marks, or after the last block to the results."""

    def one(index: Index, look: bytehash.Lookup, part: pa.RecordBatch) -> pa.Array:
        words = Words(part.column(0))
        start, window, row = _mark(index, look, words)
        edge = np.zeros(len(words.hash) + 1, np.int64)
        np.add.at(edge, start, 1)
        np.add.at(edge, start + index.size[window], -1)
        hit = np.cumsum(edge)[:-1] > 0
        items: list[set] = [set() for _ in range(part.num_rows)]
        for r, w in set(zip(row.tolist(), window.tolist())):
            items[r].update(index.names[i] for i in index.items(w))
        if part.num_columns > 1:
            for r, (bits, names) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                a, b = words.rows[r], words.rows[r + 1]
                hit[a:b] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
                items[r].update(names)
        if not last:
            bits = [np.packbits(hit[a:b]).tobytes() for a, b in zip(words.rows[:-1], words.rows[1:])]
            return pa.StructArray.from_arrays([pa.array(bits, pa.binary()), pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                                              ["hit", "items"])
        sums = np.r_[0, np.cumsum(hit)]
        listed = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]
        return pa.StructArray.from_arrays([pa.array(np.diff(words.rows)), pa.array(np.diff(sums[words.rows])),
                                           pa.array([len(x) for x in items], pa.int64()), pa.array(listed, pa.string())], RESULTS)

    def each(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        held("decontaminate", dict)
        index = shared.value
        look = bytehash.Lookup(index.shingle)
        for columns in batches:
            batch = pa.RecordBatch.from_arrays(list(columns), names=["t", "hit", "items"][:len(columns)])
            parts = [one(index, look, part) for part in slices(batch, "t", AT_ONCE)] or [one(index, look, batch)]
            yield pa.concat_arrays(parts)

    if last:
        kind = "struct<" + ",".join(f"{c}:{'string' if c == RESULTS[3] else 'bigint'}" for c in RESULTS) + ">"
    else:
        kind = "struct<hit:binary,items:array<string>>"
    return each, kind


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row of ``docs`` with all its columns and _n_words, _n_hit, _n_items, _items_sha256."""
    refuse(docs, *RESULTS)
    marks, made = fresh(docs, "marks", "made")
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()  # repeats add nothing
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).head().n or 0
    blocks = -(-total // block_bytes) or 1
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        index = Index([(r.item_id, r.text) for r in part.collect()], window)  # one block: about block_bytes
        keys = index.shingles()
        index.rarest(keys, counted(docs, text, keys, bool(index.alone.any())))
        last = block == blocks - 1
        each, kind = _marker(docs.sparkSession.sparkContext.broadcast(index), last)
        if block:
            out = F.arrow_udf(_many(each), kind)(F.col(text), F.col(f"{marks}.hit"), F.col(f"{marks}.items"))
        else:
            out = F.arrow_udf(_single(each), kind)(F.col(text))
        if last:
            return docs.withColumn(made, out).select(*[F.col(f"`{c}`") for c in docs.columns if c != marks],
                                                     *[F.col(f"{made}.{c}") for c in RESULTS])
        docs, _ = stored(docs.withColumn(marks, out), "decontaminate")
    return docs


def _single(each):
    def alone(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return each((t,) for t in texts)
    return alone


def _many(each):
    def several(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return each(columns)
    return several


def op8(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    out = contamination(docs.select("doc_id", "text"), benchmark)
    return out.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"), F.col("_n_items").alias("n_items"),
                      F.col("_items_sha256").alias("items_sha256"), (F.col("_n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
v AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
g AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM v))),
h AS (SELECT r, i, g.n, item_id FROM g JOIN v ON g.n = v.n AND g.g = v.g),
x AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r),
y AS (SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS k
      FROM (SELECT DISTINCT r, item_id::VARCHAR AS k FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(k, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN x ON d.r = x.r LEFT JOIN y ON d.r = y.r
"""
