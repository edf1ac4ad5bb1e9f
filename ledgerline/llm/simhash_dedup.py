"""SimHash near-duplicate groups with bit-sliced comparison.

Fingerprints: texts in lower case (A-Z only), words ``[^\\x20\\x09-\\x0D]+``, shingles of three words
with repeats (fewer words: the whole sequence; none, null or empty text: fingerprint zero, linked like
any other), XXH64 with seed 42; a bit is 1 when set in over half of the hashes.

Links: two fingerprints link at ``radius`` or fewer differing bits.  Distinct fingerprints only are
compared.  Of four blocks of 16 bits two must be equal (radius 2), so six tables keyed by 32 bits hold
every link.  A key with more than ``HOT`` fingerprints is dealt again by the same rule on its other
32 bits; a group then has 16 free bits, so at most 65,536 members, whatever the input's size.
Inside a group the bits lie in vertical planes: one machine word holds a bit of 64 members, distances
grow by carry-save addition, and words whose members all exceed the radius are abandoned.  A group
gives a link per member to the first of its component, never all pairs.

Components: alternating star contraction on the links, each round written to the shared folder.
``component_id`` is the smallest doc_id of the component (nulls aside; null when all are null).
Rows repeated, ids repeated or null: every row gets its own fingerprint and its group's id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, held, stored, text_key, text_map

SHINGLE, RADIUS, HOT, SEED = 3, 2, 1024, 42
LANES = np.uint64(0x0101010101010101)


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes.  Eight byte-wide counters share a word; a word takes
    255 additions before its counters are widened."""
    n, out = len(hashes), 0
    starts = np.arange(0, n, 255)
    for bit in range(8):
        counts = np.add.reduceat((hashes >> np.uint64(bit)) & LANES, starts).view(np.uint8).reshape(-1, 8).sum(0, dtype=np.int64)
        for byte in np.flatnonzero(2 * counts > n):
            out |= 1 << (8 * int(byte) + bit)
    return out


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, SEED)
    stops = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(stops[:-1] + 1).tolist()]
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, stops[shingle - 1:].tolist())]
    return majority(np.array(hashes, np.uint64))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, tk (text key), fp (the 64 bits as a signed long) of every row."""

    def setup():
        held("simhash", dict)
        return lambda texts: [np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)]

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_key(F.col(text)).alias("tk"), F.col(text).alias("t"))
    return text_map(rows, "t", {"fp": "long"}, setup, carry=["doc_id", "tk"])


class Planes:
    """Bit planes of a group's fingerprints: word w of plane b holds bit b of members 64w to 64w+63."""

    def __init__(self, fps: np.ndarray):
        self.n = len(fps)
        varying = int(np.bitwise_or.reduce(fps ^ fps[0]))
        self.bits = [b for b in range(64) if varying >> b & 1]
        words = -(-self.n // 64)
        self.rows = np.array([(fps >> np.uint64(b)) & np.uint64(1) for b in self.bits], np.uint8).reshape(len(self.bits), self.n)
        padded = np.zeros((len(self.bits), words * 64), np.uint8)
        padded[:, :self.n] = self.rows
        self.planes = np.packbits(padded, axis=1, bitorder="little").view(np.uint64)
        self.full = np.full(words, ~np.uint64(0))
        if self.n % 64:
            self.full[-1] = np.uint64((1 << (self.n % 64)) - 1)

    def near(self, queries: np.ndarray, among: np.ndarray, radius: int) -> np.ndarray:
        """Words with the members of ``among`` within the radius of any query."""
        q, w = np.nonzero(np.broadcast_to(among != 0, (len(queries), len(among))))
        width = radius.bit_length()
        counters = [np.zeros(len(q), np.uint64) for _ in range(width)]
        over = np.zeros(len(q), np.uint64)
        for step, b in enumerate(range(len(self.bits))):
            flip = np.where(self.rows[b, queries], ~np.uint64(0), np.uint64(0))
            carry = self.planes[b][w] ^ flip[q]
            for k in range(width):
                carry, counters[k] = counters[k] & carry, counters[k] ^ carry
            over |= carry
            if step % 4 == 3:  # words whose members all exceed the radius go
                beyond = over | self._above(counters, radius)
                alive = np.flatnonzero((~beyond & among[w]) != 0)
                if len(alive) < 0.7 * len(q):
                    q, w, over = q[alive], w[alive], over[alive]
                    counters = [c[alive] for c in counters]
                    if not len(q):
                        break
        out = np.zeros(len(among), np.uint64)
        np.bitwise_or.at(out, w, ~(over | self._above(counters, radius)) & among[w])
        return out

    @staticmethod
    def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
        """Members whose counter is greater than the radius, bit by bit from the highest."""
        above, equal = np.zeros_like(counters[0]), np.full_like(counters[0], ~np.uint64(0))
        for k in reversed(range(len(counters))):
            if radius >> k & 1:
                equal &= counters[k]
            else:
                above |= equal & counters[k]
                equal &= ~counters[k]
        return above


def roots(fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each of a group's distinct fingerprints the first member of its component in the group."""
    planes = Planes(fps)
    left, root = planes.full.copy(), np.arange(len(fps))
    members = lambda words: np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little")[:len(fps)])
    for i in range(len(fps)):
        if not int(left[i >> 6]) >> (i & 63) & 1:
            continue
        left[i >> 6] &= ~np.uint64(1 << (i & 63))
        front = np.array([i])
        while len(front):
            found = []
            for at in range(0, len(front), 64):
                hit = planes.near(front[at:at + 64], left, radius)
                left &= ~hit
                found.append(members(hit))
            front = np.concatenate(found)
            root[front] = i
    return root


def _keyed(df: DataFrame, free: list[int], bits: int, names: tuple[str, str], keep: tuple[str, ...]) -> DataFrame:
    """A row per pair of the four blocks of the free bits: which pair, and its bits."""
    mask = (1 << bits) - 1
    block = lambda at: F.shiftrightunsigned("fp", at).bitwiseAND(F.lit(mask).cast("long"))
    pairs = [F.struct(F.lit(n).alias("p"), F.shiftleft(block(a), bits).bitwiseOR(block(b)).alias("k"))
             for n, (a, b) in enumerate(combinations(free, 2))]
    return df.select("fp", *keep, F.explode(F.array(*pairs)).alias("x")).select(
        "fp", *keep, F.col("x.p").alias(names[0]), F.col("x.k").alias(names[1]))


def candidates(distinct: DataFrame, hot: int = HOT) -> tuple[DataFrame, str]:
    """fp with the group (p, k, p2, k2) it is compared in; hot groups are dealt again.  And the place of
    the table of group sizes that this reads."""
    first = _keyed(distinct, [0, 16, 32, 48], 16, ("p", "k"), ())
    sizes, path = stored(first.groupBy("p", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-groups")
    again = sizes.where(F.col("n") > hot).select("p", "k")
    some = first.join(sizes.where(F.col("n") <= hot).select("p", "k"), ["p", "k"]).select(
        "fp", "p", "k", F.lit(0).alias("p2"), F.lit(0).cast("long").alias("k2"))
    if again.isEmpty():
        return some, path
    parts = [some]
    dense = first.join(again, ["p", "k"])
    for n, used in enumerate(combinations([0, 16, 32, 48], 2)):
        free = [at + half for at in (0, 16, 32, 48) if at not in used for half in (0, 8)]
        parts.append(_keyed(dense.where(F.col("p") == n), free, 8, ("p2", "k2"), ("p", "k"))
                     .select("fp", "p", "k", (F.col("p2") + 1).alias("p2"), "k2"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out, path


def links(distinct: DataFrame, radius: int = RADIUS, hot: int = HOT) -> tuple[DataFrame, str]:
    """Distinct (u, v), u > v, fingerprints, written; connected exactly as all pairs within the radius
    are.  And their place."""
    if radius != 2:
        raise ValueError("the block rule (two of four blocks equal) is for a radius of 2")
    group = ["p", "k", "p2", "k2"]
    found, sizes = candidates(distinct, hot)
    dealt = found.repartition(*group).sortWithinPartitions(*group, "fp")

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for f in frames:
            f = f if rest is None else pd.concat([rest, f], ignore_index=True)
            if not len(f):
                continue
            keys = f[group].to_numpy()
            last = int(np.flatnonzero((keys != keys[-1]).any(1))[-1]) + 1 if (keys != keys[-1]).any() else 0
            rest = f.iloc[last:]
            yield linked(f.iloc[:last])
        if rest is not None:
            yield linked(rest)

    def linked(f: pd.DataFrame) -> pd.DataFrame:
        fps, keys = f["fp"].to_numpy(np.int64).view(np.uint64), f[group].to_numpy()
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)]) if len(f) else np.zeros(0, int)
        sizes = np.diff(np.r_[starts, len(f)])
        two = starts[sizes == 2]
        a, b = fps[two], fps[two + 1] if len(two) else fps[:0]
        near = np.bitwise_count(a ^ b) <= radius
        us, vs = [a[near]], [b[near]]
        for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
            own = fps[s:s + n]
            r = roots(own, radius)
            linked_to = np.flatnonzero(r != np.arange(n))
            us.append(own[linked_to])
            vs.append(own[r[linked_to]])
        u, v = np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64)
        return pd.DataFrame({"u": np.maximum(u, v), "v": np.minimum(u, v)})

    out = stored(dealt.mapInPandas(each, "u long, v long").distinct(), "simhash-edges")
    drop_stored(distinct.sparkSession, sizes)
    return out


def components(edges: DataFrame, path: str) -> tuple[DataFrame, str]:
    """(u, v): every linked node but the smallest of its component, with that smallest node.  Takes and
    gives a written table and its place; the tables of the rounds are deleted.

    Large-star and small-star steps alternate until every node points at a node that points nowhere.
    The least neighbours are written before they are joined, so a hub's many edges can be split."""
    spark = edges.sparkSession
    while True:
        old = path
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least, least_at = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "simhash-least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large, large_at = stored(large, "simhash-large")
        low, low_at = stored(large.groupBy("u").agg(F.min("v").alias("m")), "simhash-least")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, path = stored(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "simhash-edges")
        drop_stored(spark, old, least_at, large_at, low_at)
        deeper = edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi")
        if deeper.isEmpty():
            return edges, path


def groups(prints: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint of ``prints`` (doc_id, fp)."""
    distinct, distinct_at = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    stars, stars_at = components(*links(distinct.select("fp"), radius, hot))
    member = distinct.join(stars.withColumnRenamed("u", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("v", "fp").alias("root"))
    member, member_at = stored(member, "simhash-member")
    least, least_at = stored(member.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-component")
    out, _ = stored(member.join(least, "root").select("fp", "root", "component_id"), "simhash-groups")
    drop_stored(prints.sparkSession, distinct_at, stars_at, member_at, least_at)
    return out


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """doc_id, tk, fp, root (least fingerprint of the component), component_id of every row."""
    prints, _ = stored(fingerprints(docs, key, text, shingle), "simhash-prints")
    return prints.join(groups(prints, radius), "fp")


def keepers(found: DataFrame) -> DataFrame:
    """(doc_id, tk) of the row that stays of each component: the smallest id, nulls last, then text key."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tk")).alias("k")
    return found.groupBy("root").agg(first).select("k.doc_id", "k.tk")


def op10(docs: DataFrame) -> DataFrame:
    """Row per document: doc_id, fingerprint (16 lowercase hex digits), component_id."""
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
