"""Exact substring dedup over the whole corpus by hash-compared suffix sorting.

A byte goes when a string of ``WINDOW`` bytes over it also starts earlier: in a smaller doc_id, or
earlier in the same document.  Strings are judged on the input and never cross documents.

Which suffixes have to be compared?  Of the 32-byte strings inside a window, the one of least hash is the
window's anchor.  Equal windows have equal anchors at equal offsets, so only suffixes that start at the
same offset before equal anchors are compared, wherever they lie.  Consecutive windows of one anchor form
a segment (about 35 of them).  The steps, each over the whole corpus:

1. Documents are packed into chunks, written once; a chunk's place is its identity later on.
2. Chunks send their distinct anchors; an anchor that occurs in several chunks or in several different
   segments comes back to its chunks as *shared* (all its segments are equal) or *mixed*.
3. Chunks send, per shared anchor, its first segment's hashes and place; per mixed anchor the text of
   each different segment.  The suffixes of all windows of the texts are mergesorted by hash-compared
   common extensions and verified byte by byte (suffix_sort.py); of equal ones all but the earliest go.
   Equal segments of a chunk are sent once: the later ones go whatever the rest holds.
4. Chunks mark the bytes and give each document's result.

An anchor with more than ``HOT`` different segments (the edge of a passage in very many documents) would
gather without bound; its windows are sent one by one instead, by two independent 64-bit hashes, each
chunk's equal ones as one, so that no group exceeds the number of chunks.  Whole equal segments of
different chunks are told by the same two hashes (128 bits), all other equalities by bytes: those of a
chunk are compared with the first of their class, sorted suffixes with their neighbours.

Null texts are empty; a null doc_id sorts first; rows that repeat an id are documents of their own, the
one packed earlier counts as the smaller.  Every row of the input gives one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytehash
from .common import slices, stored, utf8
from .suffix_sort import Suffixes

WINDOW, ANCHOR, HOT = 100, 32, 4096
CHUNK_BYTES, BUCKET_BYTES, ANCHOR_BYTES = 1 << 20, 8 << 20, 32 << 20
VALUE2 = np.random.default_rng(977).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
SHARED, MIXED, CROWDED = 1, 2, 3
NULL_ID = -(1 << 63)


def pack(docs: DataFrame, key: str, text: str, most: int) -> DataFrame:
    """Chunks: chunk, ids, ends (byte offsets), size, blob (compressed texts, by id)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in slices(batch, "t", most):
                ids = np.array([NULL_ID if i is None else i for i in part.column(0).to_pylist()], np.int64)
                part = part.take(pa.array(np.argsort(ids, kind="stable")))
                raw, rows = utf8(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                     pa.array([rows[1:]], pa.list_(pa.int64())), pa.array([len(raw)], pa.int64()),
                     pa.array([press.compress(raw.tobytes())], pa.binary())], names=["chunk", "ids", "ends", "size", "blob"])
                number += 1

    return docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t")).mapInArrow(
        each, "chunk long, ids array<long>, ends array<long>, size long, blob binary")


class Chunk:
    """A chunk's bytes and segments, and their classes (equal anchor, offset and bytes)."""

    def __init__(self, ids, ends, blob: bytes):
        self.raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
        self.rows = np.r_[0, np.asarray(ends, np.int64)]
        self.ids = np.array([NULL_ID if i is None or i != i else int(i) for i in ids], np.int64)
        self._segments()
        while True:
            order = np.lexsort((np.arange(len(self.a)), self.c2, self.c, self.a))
            a, c, c2 = self.a[order], self.c[order], self.c2[order]
            new_a = np.r_[True, a[1:] != a[:-1]] if len(a) else np.zeros(0, bool)
            new = new_a | np.r_[True, (c[1:] != c[:-1]) | (c2[1:] != c2[:-1])] if len(a) else new_a
            false = self._deceived(order[~new], order[new][np.cumsum(new)[~new] - 1])
            if not len(false):
                break
            self.c2[false] = bytehash.mix(self.c2[false] + np.arange(1, len(false) + 1, dtype=np.uint64))
        self.first = order[new]  # first segment of each class, by anchor
        self.later = order[~new]
        self.anchors = a[new_a]
        self.class_of_anchor = np.searchsorted(np.flatnonzero(new), np.flatnonzero(new_a))  # first class of each anchor
        self.classes = np.diff(np.r_[self.class_of_anchor, len(self.first)])

    def _deceived(self, later: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Those of the later segments whose bytes are not those of the first one of their class."""
        size = self.hi[later] - self.lo[later] + WINDOW
        wrong = size != self.hi[first] - self.lo[first] + WINDOW
        out = [later[wrong]]
        later, first, size = later[~wrong], first[~wrong], size[~wrong]
        for at in range(0, len(later), 1 << 14):  # some two million bytes at once
            n, x, y = (v[at:at + (1 << 14)] for v in (size, self.lo[later], self.lo[first]))
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            differ = self.raw[np.repeat(x, n) + step] != self.raw[np.repeat(y, n) + step]
            out.append(later[at:at + (1 << 14)][np.logical_or.reduceat(differ, np.cumsum(n) - n)])
        return np.concatenate(out)

    def _segments(self) -> None:
        """lo, hi (first and last window), at (anchor), a, c, c2 (hashes of anchor and of the segment)."""
        raw, width = self.raw, WINDOW - ANCHOR + 1
        self.hash = bytehash.PrefixHash(raw)
        gram = bytehash.mix(self.hash.fixed(ANCHOR))
        windows = max(0, len(gram) - width + 1)
        inside = np.zeros(windows + 1, np.int8)
        long = np.diff(self.rows) >= WINDOW
        np.add.at(inside, self.rows[:-1][long], 1)
        stop = self.rows[1:][long] - WINDOW + 1
        np.add.at(inside, stop, -1)
        start = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8) > 0)
        if not len(start):
            self.lo = self.hi = self.at = np.zeros(0, np.int64)
            self.a = self.c = self.c2 = np.zeros(0, np.uint64)
            return
        # least hash of each window, ties to the left: block-wise running minima from both sides
        low32 = np.uint64(0xFFFFFFFF)
        packed = (gram & ~low32) | np.arange(len(gram), dtype=np.uint64)
        padded = np.full(-(-len(gram) // width) * width + width, ~np.uint64(0))
        padded[:len(gram)] = packed
        blocks = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()[width - 1:width - 1 + windows]
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()[:windows]
        anchor = (np.minimum(ahead, behind) & low32).astype(np.int64)[start]
        del packed, padded, blocks, ahead, behind
        new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)])
        self.lo, self.hi = start[new], start[np.r_[new[1:] - 1, len(start) - 1]]
        self.at = anchor[new]
        self.a = gram[self.at]
        offset = (self.at - self.lo).astype(np.uint64) * np.uint64(0x9E37) + (self.hi - self.lo).astype(np.uint64)
        self.c = bytehash.mix(self.hash.of(self.lo, self.hi + WINDOW) + offset)
        self.c2 = bytehash.mix(bytehash.PrefixHash(raw, VALUE2).of(self.lo, self.hi + WINDOW) + offset)

    def doc(self, places: np.ndarray) -> np.ndarray:
        return self.ids[np.searchsorted(self.rows, places, side="right") - 1]

    def kinds(self, anchors: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Kind of each class's anchor from what came back (0: occurs once)."""
        own = np.zeros(len(self.anchors), np.uint8)
        at = np.searchsorted(self.anchors, anchors)
        own[at] = kinds
        return np.repeat(own, self.classes)

    def crowded(self, kind: np.ndarray):
        """Windows of crowded anchors: starts, both hashes, and whether an equal one is earlier here."""
        seg = np.sort(self.first[kind == CROWDED])
        size = self.hi[seg] - self.lo[seg] + 1
        start = np.repeat(self.lo[seg], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        if not len(start):
            return start, self.a[:0], self.a[:0], np.zeros(0, bool)
        h = bytehash.mix(self.hash.of(start, start + WINDOW))
        h2 = bytehash.mix(bytehash.PrefixHash(self.raw, VALUE2).of(start, start + WINDOW))
        order = np.lexsort((start, h2, h))
        again = np.zeros(len(start), bool)
        again[order[1:]] = (h[order][1:] == h[order][:-1]) & (h2[order][1:] == h2[order][:-1])
        return start, h, h2, again


def bucket_of(a: np.ndarray, buckets: int) -> np.ndarray:
    return (bytehash.mix(a * np.uint64(0xA0761D6478BD642F)) % np.uint64(buckets)).astype(np.int64)


def _split(values: np.ndarray, buckets: int):
    """(bucket, places) of the non-empty buckets."""
    own = bucket_of(values, buckets)
    order = np.argsort(own, kind="stable")
    edges = np.flatnonzero(np.r_[True, np.diff(own[order]) != 0]) if len(own) else []
    for a, b in zip(edges, [*edges[1:], len(order)]):
        yield int(own[order[a]]), order[a:b]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Chunk]]:
    for batch in batches:
        for n in range(batch.num_rows):
            row = {c: batch.column(batch.schema.get_field_index(c))[n].as_py() for c in ("chunk", "ids", "ends", "blob")}
            yield row["chunk"], Chunk(row["ids"], row["ends"], row["blob"])


def anchors(chunks: DataFrame, buckets: int) -> DataFrame:
    """Per chunk and bucket the distinct anchors, the hash of their segment and how many differ."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in _chunks(batches):
            a, c = chunk.anchors, (chunk.c ^ (chunk.c2 << np.uint64(1)))[chunk.first[chunk.class_of_anchor]]
            n = np.minimum(chunk.classes, 65535).astype(np.uint16)
            for bucket, at in _split(a, buckets):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket]), pa.array([number]), *[pa.array([x[at].tobytes()], pa.binary()) for x in (a, c, n)]],
                    names=["bucket", "chunk", "a", "c", "n"])

    return chunks.select("chunk", "ids", "ends", "blob").mapInArrow(each, "bucket long, chunk long, a binary, c binary, n binary")


def _joined(column, kind) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(x, kind) for x in column]
    return np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def repeated(sent: DataFrame, hot: int) -> DataFrame:
    """(chunk, kind = 0, a, k): anchors that are shared, mixed or crowded."""

    def one(f: pd.DataFrame) -> pd.DataFrame:
        a, owner = _joined(f["a"], np.uint64)
        c, n = _joined(f["c"], np.uint64)[0], _joined(f["n"], np.uint16)[0].astype(np.int64)
        order = np.argsort(a, kind="stable")
        first = np.flatnonzero(np.r_[True, a[order][1:] != a[order][:-1]])
        size = np.diff(np.r_[first, len(a)])
        total = np.add.reduceat(n[order], first)
        alike = (np.minimum.reduceat(c[order], first) == np.maximum.reduceat(c[order], first)) & (total == size)
        kind = np.where(total < 2, 0, np.where(alike, SHARED, np.where(total > hot, CROWDED, MIXED)))
        back = np.empty(len(a), np.uint8)
        back[order] = np.repeat(kind, size)
        parts = np.searchsorted(owner, np.arange(len(f) + 1))
        some = [np.flatnonzero(back[x:y]) + x for x, y in zip(parts, parts[1:])]
        return pd.DataFrame([(c, 0, a[s].tobytes(), back[s].tobytes()) for c, s in zip(f["chunk"], some) if len(s)],
                            columns=["chunk", "kind", "p", "q"])

    return sent.groupBy("bucket").applyInPandas(one, "chunk long, kind int, p binary, q binary")


def _answers(f: pd.DataFrame, kind: int) -> tuple[bytes, bytes]:
    own = f[f["kind"] == kind]
    return b"".join(own["p"]), b"".join(own["q"])


def candidates(chunks: DataFrame, answers: DataFrame, buckets: int) -> DataFrame:
    """What chunks send of their repeated anchors, per bucket and kind."""
    names = ["bucket", "chunk", "kind", "p", "q", "doc", "at", "offset", "size", "text"]

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if not len(left) or not len(right):
            return pd.DataFrame(rows, columns=names)
        row = left.iloc[0]
        chunk = Chunk(row["ids"], row["ends"], row["blob"])
        a, k = _answers(right, 0)
        kind = chunk.kinds(np.frombuffer(a, np.uint64), np.frombuffer(k, np.uint8))
        press = zstandard.ZstdCompressor(level=1)
        for which in (SHARED, MIXED):
            seg = chunk.first[kind == which]
            for bucket, at in _split(chunk.a[seg], buckets):
                s = seg[at]
                text = b"".join([chunk.raw[x:y].tobytes() for x, y in zip(chunk.lo[s], chunk.hi[s] + WINDOW)]) if which == MIXED else b""
                rows.append((bucket, row["chunk"], which, (chunk.c if which == SHARED else chunk.a)[s].tobytes(), (chunk.c2 if which == SHARED else chunk.c)[s].tobytes(),
                             chunk.doc(chunk.lo[s]).tobytes(), chunk.lo[s].astype(np.int64).tobytes(),
                             (chunk.at - chunk.lo)[s].astype(np.uint8).tobytes(), (chunk.hi - chunk.lo + 1)[s].astype(np.uint8).tobytes(),
                             press.compress(text)))
        start, h, h2, again = chunk.crowded(kind)
        start, h, h2 = start[~again], h[~again], h2[~again]
        for bucket, at in _split(h, buckets):
            rows.append((bucket, row["chunk"], CROWDED, h[at].tobytes(), h2[at].tobytes(), chunk.doc(start[at]).tobytes(),
                         start[at].tobytes(), b"", b"", b""))
        return pd.DataFrame(rows, columns=names)

    return chunks.select("chunk", "ids", "ends", "blob").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        one, "bucket long, chunk long, kind int, p binary, q binary, doc binary, at binary, offset binary, size binary, text binary")


def _rank(doc: np.ndarray, chunk: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rank of each place in the order of the corpus: doc_id, chunk, place in the chunk."""
    rank = np.empty(len(doc), np.int64)
    rank[np.lexsort((at, chunk, doc))] = np.arange(len(doc))
    return rank


def later(sent: DataFrame) -> DataFrame:
    """(chunk, kind, p, q): shared classes and crowded windows that are earlier elsewhere; of mixed
    classes a bit per window, by its offset before the anchor."""

    def one(f: pd.DataFrame) -> pd.DataFrame:
        out = []
        for which, own in f.groupby("kind"):
            own = own.reset_index(drop=True)
            p, owner = _joined(own["p"], np.uint64)
            q, doc, at = _joined(own["q"], np.uint64)[0], _joined(own["doc"], np.int64)[0], _joined(own["at"], np.int64)[0]
            rank = _rank(doc, own["chunk"].to_numpy()[owner], at)
            if which == MIXED:
                marks = mixed(own, p, rank)
                gone = np.flatnonzero(marks.any(1))
                keys, values = q, marks
            else:
                order = np.lexsort((rank, q, p))
                same = np.r_[False, (p[order][1:] == p[order][:-1]) & (q[order][1:] == q[order][:-1])]
                gone = np.sort(order[same])
                keys, values = p, q
            parts = np.searchsorted(owner[gone], np.arange(len(own) + 1))
            for n, (x, y) in enumerate(zip(parts, parts[1:])):
                if y > x:
                    out.append((own["chunk"][n], which, keys[gone[x:y]].tobytes(), values[gone[x:y]].tobytes()))
        return pd.DataFrame(out, columns=["chunk", "kind", "p", "q"])

    return sent.groupBy("bucket").applyInPandas(one, "chunk long, kind int, p binary, q binary")


def mixed(own: pd.DataFrame, a: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Bits (13 bytes) per segment: the windows, by offset before the anchor, that are earlier elsewhere."""
    raw = np.frombuffer(b"".join(zstandard.ZstdDecompressor().decompress(x) for x in own["text"]), np.uint8)
    offset, size = (_joined(own[c], np.uint8)[0].astype(np.int64) for c in ("offset", "size"))
    begin = np.cumsum(size + WINDOW - 1) - (size + WINDOW - 1)
    seg = np.repeat(np.arange(len(a)), size)
    step = np.arange(len(seg)) - np.repeat(np.cumsum(size) - size, size)
    before = offset[seg] - step  # the window starts so many bytes before the anchor
    start = begin[seg] + step
    order = np.lexsort((rank[seg], before, a[seg]))
    seg, before, start = seg[order], before[order], start[order]
    group = np.cumsum(np.r_[False, (a[seg][1:] != a[seg][:-1]) | (before[1:] != before[:-1])])
    suffixes = Suffixes(raw, WINDOW)
    # a window whose hash no other of its group has is equal to none: only the others are sorted
    hashes = suffixes.windows(start)
    order = np.lexsort((hashes, group))
    same = (group[order][1:] == group[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    alone = np.ones(len(order), bool)
    alone[order[1:][same]] = alone[order[:-1][same]] = False
    seg, before, start, group = seg[~alone], before[~alone], start[~alone], group[~alone]
    bits = np.zeros((len(a), 104), np.uint8)
    if not len(seg):
        return np.packbits(bits, axis=1)
    order, cls = suffixes.classes(start, group)
    seg, before = seg[order], before[order]
    least = np.minimum.reduceat(rank[seg], np.flatnonzero(np.r_[True, cls[1:] != cls[:-1]]))[cls]
    gone = rank[seg] > least
    bits[seg[gone], before[gone]] = 1
    return np.packbits(bits, axis=1)


def results(chunks: DataFrame, answers: DataFrame, full: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with ``full`` the removed
    byte ranges and the kept bytes."""

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["spans", "kept"] * full
        if not len(left):
            return pd.DataFrame([], columns=names)
        row = left.iloc[0]
        chunk = Chunk(row["ids"], row["ends"], row["blob"])
        edge = np.zeros(len(chunk.raw) + 1, np.int64)

        def gone(first: np.ndarray, last: np.ndarray) -> None:
            """Windows first..last go: the bytes they cover."""
            np.add.at(edge, first, 1)
            np.add.at(edge, last + WINDOW, -1)

        gone(chunk.lo[chunk.later], chunk.hi[chunk.later])
        a, k = _answers(right, 0)
        kind = chunk.kinds(np.frombuffer(a, np.uint64), np.frombuffer(k, np.uint8))
        c, c2 = (np.frombuffer(x, np.uint64) for x in _answers(right, SHARED))
        seg = chunk.first[kind == SHARED]
        seg = seg[_among(chunk.c[seg], chunk.c2[seg], c, c2)]
        gone(chunk.lo[seg], chunk.hi[seg])
        c, bits = _answers(right, MIXED)
        if c:
            c, bits = np.frombuffer(c, np.uint64), np.unpackbits(np.frombuffer(bits, np.uint8).reshape(-1, 13), axis=1)
            seg = chunk.first[kind == MIXED]
            order = np.argsort(chunk.c[seg])
            seg = seg[order][np.searchsorted(chunk.c[seg][order], c)]
            n, before = np.nonzero(bits)
            start = chunk.at[seg[n]] - before
            gone(start, start)
        start, h, h2, again = chunk.crowded(kind)
        c, c2 = (np.frombuffer(x, np.uint64) for x in _answers(right, CROWDED))
        start = start[again | _among(h, h2, c, c2)]
        gone(start, start)
        cover = np.cumsum(edge[:-1]) > 0
        begins = cover & ~np.r_[False, cover[:-1]]
        heads = chunk.rows[:-1][chunk.rows[:-1] < len(cover)]
        begins[heads] = cover[heads]
        removed, spans = np.r_[0, np.cumsum(cover)], np.r_[0, np.cumsum(begins)]
        out = []
        for n, (x, y) in enumerate(zip(chunk.rows[:-1], chunk.rows[1:])):
            kept = chunk.raw[x:y][~cover[x:y]].tobytes()
            doc = None if chunk.ids[n] == NULL_ID else int(chunk.ids[n])
            out.append([doc, y - x, removed[y] - removed[x], spans[y] - spans[x], hashlib.sha256(kept).hexdigest()])
            if full:
                at = np.flatnonzero(np.diff(np.r_[False, cover[x:y], False].astype(np.int8)))
                out[-1] += [[{"start": int(s), "stop": int(t)} for s, t in at.reshape(-1, 2)], kept]
        f = pd.DataFrame(out, columns=names)
        f["doc_id"] = pd.array([r[0] for r in out], "Int64")
        return f

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", spans array<struct<start:long,stop:long>>, kept binary" * full
    return chunks.select("chunk", "ids", "ends", "blob").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(one, schema)


def _among(h: np.ndarray, h2: np.ndarray, p: np.ndarray, p2: np.ndarray) -> np.ndarray:
    """Which pairs (h, h2) are among the pairs (p, p2)."""
    if not len(p):
        return np.zeros(len(h), bool)
    a, b = np.r_[p, h], np.r_[p2, h2]
    order = np.lexsort((b, a))
    pair = np.cumsum(np.r_[False, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])])
    held = np.zeros(pair[-1] + 1, bool)
    held[pair[order < len(p)]] = True
    out = np.empty(len(a), bool)
    out[order] = held[pair]
    return out[len(p):]


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT, chunk_bytes: int = CHUNK_BYTES,
          bucket_bytes: int = BUCKET_BYTES, full: bool = False, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """Per document what goes (see ``results``)."""
    chunks, _ = stored(pack(docs, key, text, chunk_bytes), "suffix-chunks")
    total = chunks.agg(F.sum("size").alias("n")).head().n or 0
    buckets = -(-total // bucket_bytes) or 1
    first, _ = stored(repeated(anchors(chunks, -(-total // anchor_bytes) or 1), hot), "suffix-anchors")
    second = later(candidates(chunks, first, buckets))
    answers, _ = stored(second, "suffix-answers")
    return results(chunks, first.unionByName(answers), full)


def op4(docs: DataFrame) -> DataFrame:
    """Row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return dedup(docs)
