"""Hard-negative mining with exact integer scores from Kronecker-packed products.

Rows that take part have a label, a vector and finite components only.  A vec_id divisible by
``RELABEL`` first moves its label to (label + 1) % 10.  A component x becomes floor(256 x), and the score
of two rows is the inner product of these integers (a shorter vector goes on with zeros; a score outside
a long is held at the long's end).  Rows with vec_id divisible by ``EVERY`` are anchors.  An anchor's
positives are its first ``POSITIVES`` other rows of its label, and for each of these its negatives are the
first ``NEGATIVES`` rows of another label with LOW * positive <= 100 * negative <= HIGH * positive; rows
come by score, highest first, then by vec_id, nulls last.

Products: the components of several candidates, less the block's least component, are laid into fields of
one 64-bit integer, wide enough for the whole sum; one multiplication by an anchor's component (less the
least of the anchors) then serves all of them, and the sums are unpacked and corrected for both biases.
Where a field would pass 64 bits, the same is done with integers of any width.

Spread: anchors are cut into blocks of about ``ANCHORS`` rows and ``COMPONENTS`` components, each sent to
all tasks by itself; the rows never move.  A task keeps the best few rows of each anchor (then of each
positive) and sends only these.  Nothing is grouped by label or vector, so a common one is no hot group.

Rows repeated: each copy is a row of its own (a copy of an anchor is another row of its label), and equal
anchors are searched once and returned once per copy.  A null vec_id is no anchor but may be found.  An
empty table, or no anchor, has an empty result.  Only the three columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

from .common import drop_stored, stored

EVERY, RELABEL, SCALE = 100, 7, 256
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
#: Anchors and components of a block (8 bytes each on the driver and in every worker), rows handled at once.
ANCHORS, COMPONENTS, ROWS, TILE = 4096, 1 << 20, 8192, 32
LONG = np.iinfo(np.int64)
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def taking_part(df: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part, labels moved."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    moved = F.when(F.col("vec_id") % RELABEL == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return df.select("vec_id", "label", "embedding").where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(
        finite).select(F.col("vec_id").cast("long").alias("vec_id"), moved.alias("label"), "embedding")


def integers(column: pa.Array) -> np.ndarray:
    """Rows x components of floor(256 x), short rows with zeros; Python integers where 64 bits may not do."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    value = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(column.offsets.to_numpy())
    width = int(size.max()) if len(size) else 0
    if np.abs(value).max(initial=0) < 1 << 40:
        whole = np.floor(value * SCALE).astype(np.int64)
    else:
        whole = np.array([int(x) * SCALE if abs(x) >= 1 << 53 else int(np.floor(x * SCALE)) for x in value.tolist()], object)
    if (size == width).all():
        return whole.reshape(len(size), width)
    out = np.zeros((len(size), width), whole.dtype)
    out[np.arange(width) < size[:, None]] = whole
    return out


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1]))) if rows.shape[1] < width else rows


class Packed:
    """Candidates (rows x components) packed for products with anchors whose components lie in [low, high]."""

    def __init__(self, rows: np.ndarray, low: int, high: int):
        self.n, self.width = rows.shape
        self.least, self.low = int(rows.min(initial=0)), low
        most = self.width * (int(rows.max(initial=0)) - self.least) * (high - low)
        self.field = max(1, most.bit_length())
        size = max(abs(self.least), abs(int(rows.max(initial=0)))) * max(abs(low), abs(high)) * self.width
        wide = self.field > 64 or rows.dtype == object or size > int(LONG.max)
        rows = rows.astype(object) if wide else rows
        self.kind = object if wide else np.uint64
        self.per = 16 if wide else 64 // self.field
        biased = np.zeros((-(-self.n // self.per) * self.per, self.width), self.kind)
        biased[:self.n] = rows - self.least
        fields = biased.reshape(-1, self.per, self.width)
        self.words = np.zeros((self.width, len(fields)), self.kind)
        for k in range(self.per):
            self.words += fields[:, k].T * (self.kind(1 << k * self.field) if not wide else 1 << k * self.field)
        self.total = rows.sum(1)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Anchors x candidates: the inner products."""
        anchors = anchors.astype(object) if self.kind is object else anchors
        biased = (anchors - self.low).astype(self.kind)
        sums = np.zeros((len(anchors), self.words.shape[1]), self.kind)
        for k in range(self.width):
            sums += biased[:, k:k + 1] * self.words[k]
        mask = (1 << self.field) - 1
        if self.kind is object:
            parts = [(sums >> k * self.field) & mask for k in range(self.per)]
        else:
            parts = [(sums >> np.uint64(k * self.field) & np.uint64(mask)).astype(np.int64) for k in range(self.per)]
        out = np.stack(parts, 2).reshape(len(anchors), -1)[:, :self.n]
        out = out + self.least * anchors.sum(1)[:, None] + self.low * self.total - self.width * self.low * self.least
        return np.clip(out, int(LONG.min), int(LONG.max)).astype(np.int64) if self.kind is object else out


@dataclass
class Anchors:
    ids: np.ndarray
    label: np.ndarray
    rows: np.ndarray


class Block:
    """Rows of one task at once, ordered by vec_id (nulls last), so that a stable sort by score is the order asked for."""

    def __init__(self, batch: pa.RecordBatch, anchors: Anchors):
        ids = batch.column(0)
        self.none = np.asarray(ids.is_null())
        self.ids = ids.fill_null(0).to_numpy()
        order = np.lexsort((self.ids, self.none))
        self.none, self.ids = self.none[order], self.ids[order]
        self.label = batch.column(1).to_numpy()[order]
        rows = integers(batch.column(2))[order]
        width = max(rows.shape[1], anchors.rows.shape[1])
        self.rows, self.own = widened(rows, width), widened(anchors.rows, width)
        self.low, self.high = int(self.own.min(initial=0)), int(self.own.max(initial=0))


def best(score: np.ndarray, among: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` places of ``among`` by score, equal ones in their order."""
    own = score[among]
    if len(own) > 4 * most:
        least = np.partition(own, len(own) - most)[len(own) - most]
        among, own = among[own >= least], own[own >= least]
    return among[np.argsort(-own.astype(object) if len(own) and own.min() == LONG.min else -own, kind="stable")[:most]]


def blocks(batches: Iterator[pa.RecordBatch], anchors: Anchors) -> Iterator[Block]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= ROWS:
            yield Block(pa.Table.from_batches(held).combine_chunks().to_batches()[0], anchors)
            held, size = [], 0
    if size:
        yield Block(pa.Table.from_batches(held).combine_chunks().to_batches()[0], anchors)


class Kept:
    """The best rows found so far for each of many searches."""

    def __init__(self, most: int):
        self.most, self.found = most, {}

    def add(self, search: tuple, score: np.ndarray, none: np.ndarray, ids: np.ndarray, same: np.ndarray) -> None:
        old = self.found.get(search)
        if old is not None:
            score, none, ids, same = (np.concatenate(x) for x in zip(old, (score, none, ids, same)))
            order = np.lexsort((ids, none, ~score))[:self.most]  # ~score falls as the score grows, at any size
            score, none, ids, same = score[order], none[order], ids[order], same[order]
        self.found[search] = (score, none, ids, same)

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.found:
            size = [len(x[0]) for x in self.found.values()]
            anchor, slot = (np.repeat(np.array(x), size) for x in zip(*self.found))
            score, none, ids, same = (np.concatenate(x) for x in zip(*self.found.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.astype(np.int32)), pa.array(slot.astype(np.int32)), pa.array(score),
                 pa.array(ids, mask=none), pa.array(same)], names=["anchor", "slot", "score", "vec_id", "same"])


def searched(rows: DataFrame, search, most: int) -> DataFrame:
    """The first rows of every search (anchor, slot) over all rows: partial lists of the tasks, then their best."""
    part = rows.mapInArrow(search, "anchor int, slot int, score long, vec_id long, same boolean")
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), F.desc("same"))
    return part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def positives(rows: DataFrame, shared) -> list[list[tuple[int | None, int]]]:
    """(vec_id, score) of each anchor's positives."""
    most = POSITIVES + 1  # one of them may be the anchor itself

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, kept = shared.value, Kept(most)
        for block in blocks(batches, own):
            for label in np.unique(block.label):
                mine, there = np.flatnonzero(own.label == label), np.flatnonzero(block.label == label)
                packed = Packed(block.rows[there], block.low, block.high) if len(mine) else None
                for tile in (mine[k:k + TILE] for k in range(0, len(mine), TILE)):
                    for a, score in zip(tile, packed.scores(block.own[tile])):
                        at = best(score, np.arange(len(there)), most)
                        row = there[at]
                        same = ~block.none[row] & (block.ids[row] == own.ids[a])
                        same[same] = (block.rows[row[same]] == block.own[a]).all(1)
                        kept.add((a, 0), score[at], block.none[row], block.ids[row], same)
        yield from kept.batches()

    out = [[] for _ in shared.value.ids]
    found = searched(rows, search, most).orderBy("anchor", "rank").collect()  # six rows for each anchor of the block
    left = np.ones(len(out), bool)
    for r in found:
        if r["same"] and left[r["anchor"]]:
            left[r["anchor"]] = False  # the anchor's own row
        elif len(out[r["anchor"]]) < POSITIVES:
            out[r["anchor"]].append((r["vec_id"], r["score"]))
    return out


def negatives(rows: DataFrame, shared, pairs: list[list[tuple[int | None, int]]]) -> DataFrame:
    """(anchor, slot of the positive, rank, vec_id, score)."""
    bounds = [[(-(-LOW * s // 100), HIGH * s // 100) for _, s in own] for own in pairs]
    bounds = shared.context.broadcast(bounds)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, between, kept = shared.value, bounds.value, Kept(NEGATIVES)
        for block in blocks(batches, own):
            packed = Packed(block.rows, block.low, block.high)
            for first in range(0, len(own.ids), TILE):
                for a, score in enumerate(packed.scores(block.own[first:first + TILE]), first):
                    other = block.label != own.label[a]
                    for slot, (low, high) in enumerate(between[a]):
                        at = np.flatnonzero(other & (score >= low) & (score <= high))
                        if len(at):
                            at = best(score, at, NEGATIVES)
                            kept.add((a, slot), score[at], block.none[at], block.ids[at], np.zeros(len(at), bool))
        yield from kept.batches()

    return searched(rows, search, NEGATIVES)


class Shared:
    """A block of anchors in the tasks."""

    def __init__(self, spark, anchors: Anchors):
        self.context, self.sent = spark.sparkContext, spark.sparkContext.broadcast(anchors)

    def __getstate__(self):
        return {"sent": self.sent}

    @property
    def value(self) -> Anchors:
        return self.sent.value


def mine(df: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark, rows = df.sparkSession, taking_part(df)
    anchors = rows.where(F.col("vec_id") % EVERY == 0).groupBy("vec_id", "label", "embedding").agg(F.count(F.lit(1)).alias("copies"))
    anchors, anchors_at = stored(anchors, "anchors")
    n, size = anchors.agg(F.count(F.lit(1)), F.sum(F.size("embedding"))).first()
    if not n:
        return spark.createDataFrame([], RESULT)
    count = max(-(-n // ANCHORS), -(-size // COMPONENTS))
    anchors = anchors.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "embedding"), F.lit(count)))
    path = scratch_path(spark, "negatives")
    for number in range(count):
        own = anchors.where(F.col("block") == number).select("vec_id", "label", "embedding", "copies").toArrow()
        if not own.num_rows:
            continue
        block = Anchors(own.column(0).to_numpy(), own.column(1).to_numpy(), integers(own.column(2)))
        shared = Shared(spark, block)
        pairs = positives(rows, shared)
        copies = own.column(3).to_pylist()
        named = spark.createDataFrame(
            [(a, slot, int(block.ids[a]), i, s, copies[a]) for a, pair in enumerate(pairs) for slot, (i, s) in enumerate(pair)],
            "anchor int, slot int, anchor_id long, positive_id long, positive_score long, copies long")
        found = negatives(rows, shared, pairs).join(named, ["anchor", "slot"])
        found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
        found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                     F.col("score").alias("negative_score")).write.parquet(f"{path}/block={number}")
        shared.sent.unpersist()
    drop_stored(spark, anchors_at)
    return spark.read.schema(RESULT).option("recursiveFileLookup", True).parquet(path)


def op12(df: DataFrame) -> DataFrame:
    """Row per anchor, positive and rank: the negatives of ``embeddings``."""
    return mine(df)


ORACLE = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
        CAST(list_inner_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE label <> own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""
