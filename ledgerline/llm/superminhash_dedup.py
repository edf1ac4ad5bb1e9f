"""MinHash near-duplicate groups from SuperMinHash signatures.

Sets: texts in lower case (A-Z only), words ``[^\\x20\\x09-\\x0D]+``, the distinct shingles of ``SHINGLE``
words; fewer words: the whole sequence as one shingle; no words, null or empty text: the empty set, which
links with nothing.  A shingle is its 64-bit hash.

Signatures: every shingle deals its own random permutation of the ``PLACES`` places, drawn place by place,
and its j-th place gets the rank j plus a random fraction; a place keeps the least rank it was dealt.  The
permutations of one set's shingles are dealt side by side, rank after rank, and a set stops as soon as all
its places have a rank, since later ranks are greater.

Candidates: distinct sets only (exact copies are one).  A signature is cut into ``BANDS`` bands of
``PLACES / BANDS`` places; sets with an equal band share a bucket.  A pair at the threshold shares none
with probability (1 - 0.8^4)^32 = 5e-8.

Verification, without all pairs of a bucket: the set with the most company over all bands leads a bucket
(of near copies this is their original, so a group has one leader in all its bands).  Every set of a bucket
is compared with the leader on full sets, and their symmetric difference is kept.  Links give first
components.  What is left are pairs with a set that is not in its leader's component (outer): outer sets are
compared with all sets of their leader's group, in blocks, through the differences from the leader, since
|x - y| follows from these and what they share.  Each pair of a bucket is so compared or connected already;
pairs are never rows, and of the links found one per pair of components is returned.  No size of a bucket
changes the result.  Components: star contraction.

``component_id`` is the smallest doc_id reachable, nulls aside (null where all are null).  A null id is a
document like any other; ids repeated with other texts are separate documents, and rows repeated are equal.
An empty table has an empty result.  Only the two columns named are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytehash
from .common import drop_stored, slices, stored, text_key, utf8
from .simhash_dedup import components

SHINGLE, PLACES, BANDS = 4, 128, 32
#: Links have PERCENT * union <= 100 * intersection.
PERCENT = 80
#: Differing shingles of the outer sets, and of the sets they are compared with, that meet at once.
BLOCK, CHUNK = 1 << 18, 1 << 21
AT_ONCE = 1 << 20
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, *range(9, 14)]] = False
LOWER = np.arange(256)
LOWER[65:91] += 32
STEP = np.uint64(0x9E3779B97F4A7C15)


def spread(h: np.ndarray) -> np.ndarray:
    """Mix 64 bits (xor-shift-multiply, twice)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    raw, rows = utf8(column)
    starts, stops, at = bytehash.words(raw, rows, NOT_SPACE)
    word = spread(bytehash.PrefixHash(raw, bytehash.VALUE[LOWER]).of(starts, stops))
    odd = [np.uint64(pow(int(STEP), k + 1, 1 << 64)) for k in range(size)]
    whole = max(0, len(word) - size + 1)
    sums = np.zeros(whole, np.uint64)
    for k in range(size):
        sums += word[k:k + whole] * odd[k]
    gram, out = spread(sums), []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= size:
            out.append(np.unique(gram[a:b - size + 1]))
        elif b > a:  # few words: with their number, so that no longer sequence has the same hash
            few = np.array([(word[a:b] * np.array(odd[:b - a])).sum(dtype=np.uint64)]) + np.uint64(b - a)
            out.append(spread(few))
        else:
            out.append(word[:0])
    return out


def signatures(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """SuperMinHash signature of every set (not empty): places x (rank in the high half, fraction)."""
    least = np.full(len(sets) * places, np.iinfo(np.uint64).max)
    element = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.tile(np.arange(places, dtype=np.uint8), (len(element), 1))  # what is left of each permutation
    for rank in range(places):
        if not len(element):
            break
        draw, at = spread(element + np.uint64(int(STEP) * (rank + 1) % (1 << 64))), np.arange(len(element))
        pick = rank + ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(places - rank) >> np.uint64(32)).astype(np.int64)
        place = order[at, pick]
        order[at, pick] = order[:, rank]
        np.minimum.at(least, owner * places + place, np.uint64(rank << 32) | (draw >> np.uint64(32)))
        open_ = least.reshape(-1, places).max(1) >= np.uint64(rank + 1 << 32)
        alive = open_[owner]
        if not alive.all():
            element, owner, order = element[alive], owner[alive], order[alive]
    return least.reshape(len(sets), places)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """Sets x bands: hash of each band's places."""
    rows = signature.reshape(len(signature), bands, -1)
    out = np.zeros(rows.shape[:2], np.uint64)
    for k in range(rows.shape[2]):
        out = spread(out * STEP + rows[:, :, k])
    return out


def name_of(found: np.ndarray) -> bytes:
    """Name of a set: the same for equal sets only (128 bits)."""
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def prints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, tk, n (size of the set), sid (its name), keys (of the bands)."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_key(F.col(text)).alias("tk"), F.col(text).alias("t"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t", AT_ONCE):
                sets = shingle_sets(part.column(2), shingle)
                some = [s for s in sets if len(s)]
                keys = iter(band_keys(signatures(some)).view(np.int64))
                bands = [next(keys) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([name_of(s) if len(s) else None for s in sets], pa.binary()),
                     pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "tk", "n", "sid", "keys"])

    return rows.mapInArrow(each, "doc_id long, tk long, n long, sid binary, keys array<long>")


def full_sets(docs: DataFrame, places: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(sid, hashes) of the sets of the documents at ``places`` (id, tk), one row each."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_key(F.col(text)).alias("tk"), F.col(text).alias("t"))
    here = rows.join(places, rows["doc_id"].eqNullSafe(places["id"]) & (rows["tk"] == places["at"]), "left_semi")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "t", AT_ONCE):
                sets = shingle_sets(part.column(0), shingle)
                yield pa.RecordBatch.from_arrays([pa.array([name_of(s) for s in sets], pa.binary()),
                                                  pa.array([s.tobytes() for s in sets], pa.binary())], names=["sid", "hashes"])

    return here.select("t").mapInArrow(each, "sid binary, hashes binary").dropDuplicates(["sid"])


def _differences(pairs: DataFrame) -> DataFrame:
    """(hub, sid, n_hub, n, diff, size, linked) of pairs with both full sets: diff is their symmetric difference."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = ([np.frombuffer(v, np.uint64) for v in batch.column(k).to_pylist()] for k in (2, 3))
            diff, sizes = [], []
            for x, y in zip(*held):
                both = np.concatenate([x, y])
                both.sort()
                alone = np.ones(len(both) + 1, bool)
                alone[1:-1] = both[1:] != both[:-1]
                diff.append(both[alone[1:] & alone[:-1]])
                sizes.append((len(x), len(y)))
            n_hub, n = np.array(sizes, np.int64).reshape(-1, 2).T
            size = np.array([len(d) for d in diff], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_hub), pa.array(n), pa.array([d.tobytes() for d in diff], pa.binary()),
                 pa.array(size), pa.array(links(size, n_hub + n))], names=["hub", "sid", "n_hub", "n", "diff", "size", "linked"])

    return pairs.select("hub", "sid", "hashes_hub", "hashes").mapInArrow(
        each, "hub binary, sid binary, n_hub long, n long, diff binary, size long, linked boolean")


def links(apart, sizes):
    """PERCENT * union <= 100 * intersection, by the symmetric difference and the sum of both sizes."""
    return (100 + PERCENT) * apart <= (100 - PERCENT) * sizes


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())


def compared(group: pa.Table) -> list[tuple[bytes, bytes]]:
    """Distinct pairs of labels that a link between an outer set and another set of the group joins."""
    outer = np.asarray(group.column("outer"))
    diff = [np.frombuffer(d, np.uint64) for d in group.column("diff").to_pylist()]
    n, label = group.column("n").to_numpy(), group.column("label").to_pylist()
    code = {x: k for k, x in enumerate(sorted(set(label)))}
    names, label = list(code), np.array([code[x] for x in label])
    inside = np.flatnonzero(~outer)
    size = np.array([len(diff[k]) for k in inside])
    element = np.concatenate([diff[k] for k in inside]) if len(inside) else np.zeros(0, np.uint64)
    order = np.argsort(element, kind="stable")
    element, owner = element[order], np.repeat(np.arange(len(inside)), size)[order]
    found = set()
    for y in np.flatnonzero(outer):
        first, last = np.searchsorted(element, diff[y]), np.searchsorted(element, diff[y], side="right")
        common = np.bincount(owner[_ranges(first, last - first)], minlength=len(inside))
        good = links(size + len(diff[y]) - 2 * common, n[inside] + n[y]) & (label[inside] != label[y])
        found.update((int(label[y]), int(x)) for x in np.unique(label[inside][good]))
    return [(names[y], names[x]) for y, x in found]


def _outer_links(star: DataFrame, label: DataFrame) -> DataFrame:
    """Distinct (a, b) labels joined by links between sets of one hub's group, neither of them the hub.

    A set whose label is the hub's is inner, the others are outer; only pairs with an outer set can join
    labels.  Outer sets (by blocks) meet all sets of the group (by chunks) as differences from the hub."""
    named = lambda c: F.coalesce(f"l_{c}", c)
    light = star.select("hub", "sid", "size")
    for c in ("sid", "hub"):
        light = light.join(label.select(F.col("u").alias(c), F.col("v").alias(f"l_{c}")).hint("merge"), c, "left")
    light = light.select("hub", "sid", "size", named("sid").alias("label"), (named("sid") != named("hub")).alias("outer"))
    light, light_at = stored(light, "minhash-light")
    outside = F.when(F.col("outer"), F.col("size")).otherwise(0)
    bound = lambda total, most: F.ceil((total + 1) / most).cast("int")
    open_ = light.groupBy("hub").agg(F.count(F.lit(1)).alias("sets"), F.sum("size").alias("all"), F.sum(outside).alias("out"),
                                     F.count_if("outer").alias("outers")).where("outers > 0 and sets > 1")
    open_ = open_.select("hub", bound(F.col("out"), BLOCK).alias("blocks"), bound(F.col("all"), CHUNK).alias("chunks"))
    rows = light.drop("size").join(open_.hint("merge"), "hub").join(star.select("hub", "sid", "n", "diff").hint("merge"), ["hub", "sid"])
    spread_ = lambda count, seed: F.pmod(F.xxhash64("sid", F.lit(seed)), F.col(count)).cast("int")
    every = lambda count: F.sequence(F.lit(0), F.col(count) - 1)
    inside = rows.select("hub", F.explode(every("blocks")).alias("block"), spread_("chunks", 1).alias("chunk"), "label", "n", "diff", F.lit(False).alias("outer"))
    around = rows.where("outer").select("hub", spread_("blocks", 2).alias("block"), F.explode(every("chunks")).alias("chunk"), "label", "n", "diff", "outer")
    key = ["hub", "block", "chunk"]
    dealt = inside.unionByName(around).repartition(*key).sortWithinPartitions(*key)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in key)))
            start = 0
            for n in range(1, len(keys) + 1):
                if n == len(keys) or keys[n] != keys[start]:
                    if held and now != keys[start]:
                        yield made(held)
                        held = []
                    now = keys[start]
                    held.append(batch.slice(start, n - start))
                    start = n
        if held:
            yield made(held)

    def made(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        pairs = compared(pa.Table.from_batches(held))
        return pa.RecordBatch.from_arrays([pa.array([max(p) for p in pairs], pa.binary()), pa.array([min(p) for p in pairs], pa.binary())],
                                          names=["u", "v"])

    out, _ = stored(dealt.mapInArrow(each, "u binary, v binary").distinct(), "minhash-outer")
    drop_stored(star.sparkSession, light_at)
    return out


def groups(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(sid, label) of every set that links with another: the label is the least sid of its component."""
    spark = docs.sparkSession
    sets, sets_at = stored(found.where("n > 0").groupBy("sid").agg(
        F.min(F.struct("doc_id", "tk")).alias("place"), F.first("keys").alias("keys")), "minhash-sets")
    dealt = sets.select("sid", F.posexplode("keys").alias("band", "bucket"))
    shared, shared_at = stored(dealt.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "minhash-buckets")
    members, members_at = stored(dealt.join(shared.hint("merge"), ["band", "bucket"]), "minhash-members")
    # the set with the most company leads a bucket: the original of a group of near copies, the same in all bands
    company = members.groupBy("sid").agg(F.sum("size").alias("company"))
    leader = members.join(company.hint("merge"), "sid").groupBy("band", "bucket").agg(F.max(F.struct("company", "sid")).alias("hub"))
    pairs = members.join(leader.hint("merge"), ["band", "bucket"]).where("sid <> hub.sid").select(F.col("hub.sid").alias("hub"), "sid").distinct()
    pairs, pairs_at = stored(pairs, "minhash-pairs")
    need = sets.join(members.select("sid").distinct().hint("merge"), "sid", "left_semi")
    hashes, hashes_at = stored(full_sets(docs, need.select(F.col("place.doc_id").alias("id"), F.col("place.tk").alias("at")),
                                         key, text, shingle), "minhash-hashes")
    full = pairs.join(hashes.hint("merge"), "sid").join(
        hashes.select(F.col("sid").alias("hub"), F.col("hashes").alias("hashes_hub")).hint("merge"), "hub")
    star, star_at = stored(_differences(full), "minhash-star")
    drop_stored(spark, sets_at, shared_at, members_at, pairs_at, hashes_at)
    edges = star.where("linked").select(F.greatest("hub", "sid").alias("u"), F.least("hub", "sid").alias("v")).distinct()
    label, label_at = components(*stored(edges, "minhash-edges"))
    more = _outer_links(star, label)
    both, both_at = components(*stored(label.unionAll(more), "minhash-edges"))
    out, _ = stored(both.unionAll(both.select(F.col("v").alias("u"), "v").distinct()).select(F.col("u").alias("sid"), F.col("v").alias("label")), "minhash-labels")
    drop_stored(spark, star_at, label_at, both_at)
    return out


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, tk, n (set size), sid, component_id of every row."""
    found, _ = stored(prints(docs, key, text, shingle), "minhash-prints")
    label = groups(docs, found, key, text, shingle)
    sets = found.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("first"))
    named = sets.join(label, "sid", "left").select("sid", "first", F.coalesce("label", "sid").alias("label"))
    named, _ = stored(named, "minhash-named")
    least, _ = stored(named.groupBy("label").agg(F.min("first").alias("component_id")), "minhash-least")
    by_set, _ = stored(named.join(least, "label").select("sid", "component_id"), "minhash-components")
    # sets of one document only need no join: theirs is the id itself; the empty set has no name
    out = found.select("doc_id", "tk", "n", "sid").join(by_set, "sid", "left")
    return out.select("doc_id", "tk", "n", "sid", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep(doc_id: Column, component: Column) -> Column:
    return doc_id.eqNullSafe(component)


def op13(docs: DataFrame) -> DataFrame:
    """Row per document: doc_id, n_shingles, component_id, kept."""
    return near_duplicates(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                                        keep(F.col("doc_id"), F.col("component_id")).alias("kept"))
