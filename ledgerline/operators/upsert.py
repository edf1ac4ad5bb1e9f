"""Keyed upsert into a log-structured table (K2, K6) and insert-if-absent.

Parquet has no MERGE.  A table here is a folder of commits that are never changed, and a log:

* ``<table>/data/commit=<number>-<random>/<partitions>/*.parquet``: rows of one commit.  Base commits hold
  one row per key; delta commits hold an upserted batch, or the keys of deleted rows (``_gone``).
* ``<table>/_log/<number>.json``: what is live as of a commit: base folders, delta commits, schema, keys.
  Notes are written beside their place and moved there; old ones stay for a while, so losing the newest
  leaves the table as it was one commit earlier.
* ``<table>/_blooms/commit=<...>``: Bloom filters of the keys of every base file, made when first needed.

An upsert writes its batch as a delta and a note, nothing else: its cost is the batch, whatever the table
holds.  A reader takes the newest delta row of a key, and the base rows whose keys are in no delta; a table
without deltas is a plain scan.  Every ``COMPACT_AFTER`` deltas, or when they hold a large share of the
rows, ``compact`` folds them into the base: it opens only the base files whose filters may hold one of the
keys, and rewrites the partitions that hold them or receive rows.

Commits are numbered; a writer claims its number by creating a file that must not exist yet, so of two
writers one is refused.  A claim without a note is dead after ``LEASE_SECONDS``.  A failure before the note
leaves the table as it was.  Null, empty (stored as null) and special partition values go through Spark's own
naming.  Stored columns that a batch lacks stay, null in its rows; new columns are added.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from functools import reduce
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import DOC_KEY, PARTITION_COLS
from ledgerline.session import (claim_file, delete_path, list_folder, path_exists, read_text, scratch_path, write_text)

#: Deltas before a compaction; or rows in deltas, if they are also more than one in ... of the base's.
COMPACT_AFTER, COMPACT_ROWS, COMPACT_SHARE = 8, 1_000_000, 4
#: Seconds after which a claimed commit without a note is taken for dead; notes that are kept.
LEASE_SECONDS, KEPT_NOTES = 600, 20
#: Bits and hash functions of a Bloom filter per key; keys of one filter (a larger file has several).
BLOOM_BITS, BLOOM_HASHES, BLOOM_KEYS = 10, 7, 500_000
BLOOM_SCHEMA = pa.schema([("file", pa.string()), ("keys", pa.int64()), ("bits", pa.binary())])
#: Keys sent to all filters at once (8 bytes each); keys that a filter is asked for before the answers are looked at.
KEYS_AT_ONCE, PROBE_KEYS = 1_000_000, 4_096
#: Partition values up to which the rewritten partitions are also named in the scan's filter; beyond
#: it the join alone selects them (the result is the same).
NAMED_PARTITIONS = 5_000
GONE, COMMIT = "_gone", "commit"
BUCKET = "key_bucket_of"
#: Default number of hash partitions of a table keyed by id (K6).
DIMENSION_BUCKETS = 64


class ConcurrentWriter(RuntimeError):
    """Another writer has claimed the next commit."""


def latest_per_key(df: DataFrame, key, order_by) -> DataFrame:
    """One row per key, the one with the greatest ``order_by`` tuple (nulls lowest).

    The other columns break ties, so the choice is total and deterministic.  One scan; the row
    limit of one per key is applied inside every task before the shuffle (WindowGroupLimit), so a
    key with a large share of the rows is reduced where it is read.  Rows with a null key are told
    apart by their whole content: different ones all stay, exact copies count once.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    named = {c for c in order_by if isinstance(c, str)}
    rest = [F.col(f"`{c}`") for c in df.columns if c not in keys and c not in named]
    nameless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    others = [F.col(f"`{c}`") for c in df.columns if c not in keys]
    content = [F.when(nameless, F.struct(*others))] if others else []
    by_key = Window.partitionBy(*keys, *content).orderBy(*[c.desc_nulls_last() for c in [*order, *rest]])
    ranked = df.withColumn("_rank", F.row_number().over(by_key)) if order or rest else df.distinct().withColumn("_rank", F.lit(1))
    return ranked.where(F.col("_rank") == 1).select(*[F.col(f"`{c}`") for c in df.columns])


# ---------------------------------------------------------------------------
# The log
# ---------------------------------------------------------------------------
@dataclass
class Snapshot:
    """What is live as of one commit; folders are relative to the table's ``data``."""

    version: int = 0
    schema: dict = field(default_factory=dict)
    keys: list = field(default_factory=list)
    partition_cols: list = field(default_factory=list)
    base: list = field(default_factory=list)
    deltas: list = field(default_factory=list)
    base_rows: int = 0
    delta_rows: int = 0
    nameless: int = 0  # delta rows without a key
    garbage: list = field(default_factory=list)  # folders out of use since the last compaction

    @property
    def fields(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)


def _log(target: str) -> str:
    return f"{target.rstrip('/')}/_log"


def _data(target: str) -> str:
    return f"{target.rstrip('/')}/data"


def is_log_table(spark: SparkSession, target: str) -> bool:
    return path_exists(spark, _log(target))


def snapshot(spark: SparkSession, target: str) -> Snapshot | None:
    """The newest readable note; None where there is no table."""
    if not is_log_table(spark, target):
        if {n for n, _ in list_folder(spark, target)} - {"_catalog"}:
            raise ValueError(f"{target} exists but was not written by an upsert, or its log is lost")
        return None
    names = sorted((n for n, _ in list_folder(spark, _log(target)) if n.endswith(".json")), reverse=True)
    for name in names:
        text = read_text(spark, f"{_log(target)}/{name}")
        try:
            return Snapshot(**json.loads(text))
        except (TypeError, ValueError):
            continue
    if path_exists(spark, _data(target)):
        raise ValueError(f"the log of {target} is lost")
    return None


def _claim(spark: SparkSession, target: str, version: int) -> None:
    """Take a commit's number, or refuse; a dead writer's claim is taken over."""
    path = f"{_log(target)}/{version:08d}.claim"
    if claim_file(spark, path):
        return
    ages = {n: time.time() - at for n, at in list_folder(spark, _log(target))}
    if f"{version:08d}.json" not in ages and ages.get(f"{version:08d}.claim", 0) > LEASE_SECONDS:
        delete_path(spark, path)
        if claim_file(spark, path):
            return
    raise ConcurrentWriter(f"commit {version} of {target} belongs to another writer")


def _commit(spark: SparkSession, target: str, snap: Snapshot) -> None:
    _claim(spark, target, snap.version)
    write_text(spark, f"{_log(target)}/{snap.version:08d}.json", json.dumps(asdict(snap)))
    for name, _ in list_folder(spark, _log(target)):
        if name[:8].isdigit() and int(name[:8]) <= snap.version - KEPT_NOTES:
            delete_path(spark, f"{_log(target)}/{name}")


def recover(spark: SparkSession, target: str) -> bool:
    """Remove what interrupted writers left: dead claims and folders that no kept note names."""
    snap = snapshot(spark, target)
    if snap is None:
        return False
    notes = {n for n, _ in list_folder(spark, _log(target))}
    named = set()
    for name in notes:
        if name.endswith(".json"):
            known = Snapshot(**json.loads(read_text(spark, f"{_log(target)}/{name}")))
            named |= {f.split("/")[0] for f in [*known.base, *known.deltas, *known.garbage]}
    left = [f"{_log(target)}/{n}" for n, at in list_folder(spark, _log(target))
            if n.endswith(".claim") and n.replace(".claim", ".json") not in notes and time.time() - at > LEASE_SECONDS]
    left += [f"{_data(target)}/{n}" for n, at in list_folder(spark, _data(target))
             if n.startswith(f"{COMMIT}=") and n not in named and time.time() - at > LEASE_SECONDS]
    for path in left:
        delete_path(spark, path)
    return bool(left)


def table_schema(spark: SparkSession, target: str, partition_cols: dict[str, T.DataType]) -> T.StructType | None:
    """Schema of a stored table: noted by the last upsert, else from the files (all footers)."""
    if not path_exists(spark, target):
        return None
    if is_log_table(spark, target):
        snap = snapshot(spark, target)
        return snap.fields if snap else None
    found = spark.read.option("mergeSchema", True).parquet(target).schema
    return T.StructType([T.StructField(f.name, partition_cols.get(f.name, f.dataType)) for f in found.fields])


# ---------------------------------------------------------------------------
# Reading
# ---------------------------------------------------------------------------
def read_commit(spark: SparkSession, path: str, commit: str, schema: T.StructType) -> DataFrame:
    """The rows that one upsert wrote."""
    return _folders(spark, path, [commit], schema)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, only=None) -> DataFrame:
    """A table of upserts as of its newest commit, or a plain parquet folder.

    With ``only`` (of a partition folder's text) other base folders are not even listed; what deltas hold is
    read in any case, so callers filter the rows as well."""
    snap = snapshot(spark, path) if is_log_table(spark, path) else None
    if snap is not None and only is not None:
        snap.base = [f for f in snap.base if only(unquote(f.partition("/")[2]))]
    if snap is None:
        reader = spark.read
        return (reader.schema(schema) if schema is not None else reader).parquet(path)
    rows = resolved(spark, path, snap)
    return rows if schema is None else _aligned(rows, schema)


def _folders(spark: SparkSession, target: str, folders: list, schema: T.StructType) -> DataFrame:
    """Rows of some folders, with their commit's number."""
    full = T.StructType([*schema.fields, T.StructField(COMMIT, T.StringType())])
    if not folders:
        return spark.createDataFrame([], full)
    base = _data(target)
    return spark.read.schema(full).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders])


def _newest(spark: SparkSession, target: str, snap: Snapshot) -> DataFrame:
    """The latest delta row per key, ``_gone`` included."""
    schema = T.StructType([T.StructField(GONE, T.BooleanType()), *snap.fields.fields])
    rows = _folders(spark, target, snap.deltas, schema)
    if len(snap.deltas) == 1:
        return rows.drop(COMMIT)
    number = F.split(COMMIT, "-")[0].cast("long")
    named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in snap.keys])
    ordered = rows.withColumn(COMMIT, F.when(named, number))  # rows without a key: equal ones of two deltas are one
    return latest_per_key(ordered, snap.keys, [COMMIT]).drop(COMMIT)


def _without(rows: DataFrame, newest: DataFrame, snap: Snapshot) -> DataFrame:
    """Base rows whose key, or without a key whose whole content, is in no delta."""
    nameless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in snap.keys])
    names = [f.name for f in snap.fields.fields]
    own = newest.select(*snap.keys).where(~nameless)
    rows = rows.join(own, snap.keys, "left_anti")
    if not snap.nameless:
        return rows
    copies = newest.where(nameless).select(*names)
    return rows.join(copies, _same(rows, copies, names), "left_anti")


def resolved(spark: SparkSession, target: str, snap: Snapshot) -> DataFrame:
    """All live rows: a plain scan where there are no deltas."""
    names = [F.col(f"`{f.name}`") for f in snap.fields.fields]
    base = _folders(spark, target, snap.base, snap.fields).select(*names)
    if not snap.deltas:
        return base
    newest = _newest(spark, target, snap)
    return _without(base, newest, snap).select(*names).unionByName(newest.where(~F.col(GONE)).select(*names))


# ---------------------------------------------------------------------------
# Helpers
# ---------------------------------------------------------------------------
def _same(left: DataFrame, right: DataFrame, cols) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in cols])


def _label(pcols) -> Column:
    """Text of a partition's values, null told from every value."""
    return F.concat_ws("\x01", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in pcols])


def _in_partitions(table: DataFrame, wanted: DataFrame, pcols) -> DataFrame:
    """Rows of the wanted partitions (a small table of distinct values)."""
    some = [r[0] for r in wanted.select(_label(pcols)).limit(NAMED_PARTITIONS + 1).collect()]
    if len(some) <= NAMED_PARTITIONS:
        table = table.where(_label(pcols).isin(some)) if some else table.limit(0)
    return table.join(wanted, _same(table, wanted, pcols), "left_semi")


def _aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; missing ones are null."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def _union_schema(stored: T.StructType | None, batch: T.StructType, pcols) -> T.StructType:
    """Stored fields first, then new ones, partition columns last (as a reader lists them)."""
    fields = {f.name: f for f in (stored.fields if stored else [])}
    for f in batch.fields:
        fields.setdefault(f.name, T.StructField(f.name, f.dataType))
    return T.StructType([f for n, f in fields.items() if n not in pcols] + [fields[c] for c in pcols])


def _written(spark: SparkSession, target: str, rows: DataFrame, version: int, pcols, cluster: bool) -> str:
    """Write one commit's rows; its folder."""
    folder = f"{COMMIT}={version:08d}-{uuid.uuid4().hex[:8]}"
    if cluster and pcols:
        rows = rows.repartition(*[F.col(c) for c in pcols])
    writer = rows.write
    (writer.partitionBy(*pcols) if pcols else writer).parquet(f"{_data(target)}/{folder}")
    return folder


def _places(spark: SparkSession, target: str, folder: str, schema: T.StructType) -> list[str]:
    """The partition folders of a commit, relative to ``data`` (one row per partition on the driver)."""
    rows = _folders(spark, target, [folder], schema)
    files = rows.select(F.col("_metadata.file_path").alias("file")).distinct()
    return sorted(unquote(r[0]) for r in files.select(F.regexp_extract("file", f"/({folder}[^?]*)/[^/]*$", 1)).distinct().collect())


# ---------------------------------------------------------------------------
# Bloom filters of base files
# ---------------------------------------------------------------------------
def _bit_places(hashes: np.ndarray, bits: int, first: int = 0) -> Iterator[np.ndarray]:
    """The bit of each key, hash function by hash function."""
    one, two = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    for k in range(first, BLOOM_HASHES):
        yield (one + np.uint64(k) * two) % np.uint64(bits)


def bloom_filter(hashes: np.ndarray) -> bytes:
    bits = max(64, -(-len(hashes) * BLOOM_BITS // 64) * 64)
    out = np.zeros(bits, bool)
    for places in _bit_places(hashes, bits):
        out[places] = True
    return np.packbits(out).tobytes()


def may_hold(bloom: bytes, hashes: np.ndarray) -> bool:
    """Whether one of the keys may be in the filter's file; keys are tried ``PROBE_KEYS`` at a time, until one may be."""
    packed = np.frombuffer(bloom, np.uint8)
    for start in range(0, len(hashes), PROBE_KEYS):
        left = hashes[start:start + PROBE_KEYS]
        for k in range(BLOOM_HASHES):  # only keys whose bits were set so far are tried further
            places = next(_bit_places(left, 8 * len(packed), k))
            left = left[(packed[places >> np.uint64(3)] << (places & np.uint64(7)).astype(np.uint8)) & 128 > 0]
        if len(left):
            return True
    return False


def _filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Filters of (file, h) rows, which a task reads file after file; one for every ``BLOOM_KEYS`` rows of a file or so."""
    file, held, rows = None, [], 0

    def filled() -> Iterator[pa.RecordBatch]:
        if rows:
            bits = bloom_filter(np.concatenate(held).view(np.uint64))
            yield pa.RecordBatch.from_pydict({"file": [file], "keys": [rows], "bits": [bits]}, BLOOM_SCHEMA)

    for batch in batches:
        runs, hashes, start = pc.run_end_encode(batch.column("file")), batch.column("h").to_numpy(), 0
        for name, stop in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
            if name != file or rows >= BLOOM_KEYS:
                yield from filled()
                file, held, rows = name, [], 0
            held.append(hashes[start:stop].copy())
            rows, start = rows + stop - start, stop
    yield from filled()


def _write_blooms(spark: SparkSession, target: str, folder: str, snap: Snapshot) -> None:
    """Filters of a commit's files: no shuffle, and no task holds more of a file than one filter's keys."""
    rows = _folders(spark, target, [folder], snap.fields).select(F.col("_metadata.file_path").alias("file"), F.xxhash64(*snap.keys).alias("h"))
    filters = rows.mapInArrow(_filters, "file string, keys long, bits binary")
    filters.withColumn("file", F.regexp_extract("file", f"/({folder}.*)$", 1)).write.mode("overwrite").parquet(
        f"{target.rstrip('/')}/_blooms/{folder}")


def files_with(spark: SparkSession, target: str, snap: Snapshot, keys: DataFrame) -> list[str]:
    """Live base files (relative to ``data``) whose filter may hold one of the keys.

    Keys are looked up in blocks of about ``KEYS_AT_ONCE``, each sent to the tasks by itself, and only in the
    filters of files that no block before may be in.  A filter takes one foreign key in 120 for its own, so of a
    large batch the first keys decide on nearly every file."""
    commits = sorted({f.split("/")[0] for f in snap.base})
    if not commits:
        return []
    for commit in commits:  # a base commit's filters are made when they are first asked for
        if not path_exists(spark, f"{target.rstrip('/')}/_blooms/{commit}/_SUCCESS"):
            _write_blooms(spark, target, commit, snap)
    blooms = spark.read.schema("file string, bits binary").parquet(*[f"{target.rstrip('/')}/_blooms/{c}" for c in commits])
    live = set(snap.base)
    left = {r[0] for r in blooms.select("file").distinct().collect() if unquote(r[0]).rsplit("/", 1)[0] in live}
    hashes = keys.select(F.xxhash64(*snap.keys).alias("h")).distinct()
    hashes.write.parquet(staged := scratch_path(spark, "upsert-keys"))
    hashes = spark.read.schema("h long").parquet(staged)
    blocks = max(1, -(-hashes.count() // KEYS_AT_ONCE))
    found = set()
    for block in range(blocks):
        if not left:
            break
        own = hashes.where(F.pmod("h", F.lit(blocks)) == block).toArrow().column(0).to_numpy().view(np.uint64)
        shared = spark.sparkContext.broadcast((own, left))

        def test(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own, left = shared.value
            for f in frames:
                yield f.loc[[n in left and may_hold(b, own) for n, b in zip(f["file"], f["bits"])], ["file"]]

        here = {r[0] for r in blooms.mapInPandas(test, "file string").collect()}
        found, left = found | here, left - here
        shared.unpersist()
    delete_path(spark, staged)
    return sorted(unquote(f) for f in found)


# ---------------------------------------------------------------------------
# Upsert
# ---------------------------------------------------------------------------
def upsert(spark: SparkSession, target: str, batch: DataFrame, key: str | list = DOC_KEY, order_by=(),
           partition_cols=PARTITION_COLS, batch_metrics: dict | None = None, cluster_by_partition: bool = False,
           compact_after: int = COMPACT_AFTER) -> dict:
    """K2/K6: idempotent keyed upsert; running a batch again leaves the table equal.

    The batch wins over the stored row of its key, wherever that lies; inside the batch ``order_by``
    (larger = later) and then the other columns decide.  Rows with a null key are identified by their
    whole content.  Only the batch is written; the table is not read, but for the compaction that follows
    every ``compact_after`` deltas.  ``cluster_by_partition`` writes each partition from one task, for
    partitions of bounded size.  Returns ``rows_in_batch``, ``rows_from_batch`` (after de-duplication),
    ``touched_partitions`` (that the batch's rows are in), ``compacted``, ``commit``, and a count per ``batch_metrics``
    condition over the de-duplicated batch, all observed while the data is written.
    """
    pcols, keys = list(partition_cols), [key] if isinstance(key, str) else list(key)
    for c in pcols:
        if isinstance(batch.schema[c].dataType, T.StringType):
            batch = batch.withColumn(c, F.when(F.col(c) != "", F.col(c)))
    old = snapshot(spark, target)
    if old is not None and (old.keys, old.partition_cols) != (keys, pcols):
        raise ValueError(f"{target} is kept by {old.keys} in partitions of {old.partition_cols}")
    schema = _union_schema(old.fields if old else None, batch.schema, pcols)

    came, kept = Observation(f"came_{uuid.uuid4().hex[:12]}"), Observation(f"kept_{uuid.uuid4().hex[:12]}")
    nameless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    counted = [F.count(F.lit(1)).alias("rows_from_batch"), F.count_if(nameless).alias("nameless")]
    counted += [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in (batch_metrics or {}).items()]
    latest = latest_per_key(batch.observe(came, F.count(F.lit(1)).alias("rows_in_batch")), keys, order_by)
    rows = _aligned(latest.observe(kept, *counted), schema)
    first = old is None or not (old.base or old.deltas)
    snap = old or Snapshot()
    snap.version, snap.schema, snap.keys, snap.partition_cols = snap.version + 1, json.loads(schema.json()), keys, pcols
    folder = _written(spark, target, rows if first else rows.withColumn(GONE, F.lit(False)), snap.version, pcols, cluster_by_partition)
    stats = {**dict(came.get), **dict(kept.get)}
    without_key = stats.pop("nameless")
    places = _places(spark, target, folder, schema) if stats["rows_from_batch"] else []
    if first:
        snap.base, snap.base_rows = places, stats["rows_from_batch"]
    elif places:
        snap.deltas, snap.delta_rows = [*snap.deltas, folder], snap.delta_rows + stats["rows_from_batch"]
        snap.nameless += without_key
    _commit(spark, target, snap)
    compacted = compact(spark, target, compact_after, cluster_by_partition)
    return {"touched_partitions": len(places), "compacted": compacted, "commit": folder, **stats}


def delete_keys(spark: SparkSession, target: str, keys: DataFrame) -> None:
    """Delete rows by key: a delta that holds only the keys, marked as gone."""
    snap = snapshot(spark, target)
    rows = _aligned(keys.select(*snap.keys).distinct(), snap.fields).withColumn(GONE, F.lit(True))
    snap.version += 1
    snap.deltas = [*snap.deltas, _written(spark, target, rows, snap.version, snap.partition_cols, False)]
    _commit(spark, target, snap)


def compact(spark: SparkSession, target: str, after: int = 1, cluster_by_partition: bool = False) -> bool:
    """Fold the deltas into the base where there are ``after`` of them or they hold many rows; whether it did.

    Rewritten are the base folders that hold one of the deltas' keys (only files whose Bloom filter may hold
    one are opened to find them) and those of the partitions that receive rows; the others stay as they are."""
    snap = snapshot(spark, target)
    if snap is None or not snap.deltas:
        return False
    if len(snap.deltas) < after and not (snap.delta_rows > COMPACT_ROWS and snap.delta_rows * COMPACT_SHARE > snap.base_rows):
        return False
    schema, pcols = snap.fields, snap.partition_cols
    _newest(spark, target, snap).write.parquet(staging := scratch_path(spark, "upsert-newest"))
    newest = spark.read.schema(T.StructType([T.StructField(GONE, T.BooleanType()), *schema.fields])).parquet(staging)
    maybe = files_with(spark, target, snap, newest)
    held = _folders(spark, target, maybe, schema)
    place = F.regexp_extract(F.col("_metadata.file_path"), f"/({COMMIT}=.*)/[^/]*$", 1)
    own = newest.select(*snap.keys).distinct()
    holding = {unquote(r[0]) for r in held.select(*snap.keys, place.alias("_place")).join(
        own, _same(held, own, snap.keys), "left_semi").select("_place").distinct().collect()} if maybe else set()
    receiving = {p.partition("/")[2] for d in snap.deltas for p in _places(spark, target, d, schema)}
    replaced = [f for f in snap.base if f in holding or f.partition("/")[2] in receiving]
    names = [f.name for f in schema.fields]
    stays = _without(_folders(spark, target, replaced, schema).select(*names), newest, snap).select(*names)
    done = Observation(f"done_{uuid.uuid4().hex[:12]}")
    merged = stays.unionByName(newest.where(~F.col(GONE)).select(*names)).observe(done, F.count(F.lit(1)).alias("rows"))
    snap.version += 1
    before = _count(spark, target, replaced, schema)
    folder = _written(spark, target, merged, snap.version, pcols, cluster_by_partition)
    old = snap.garbage
    snap.garbage = [*snap.deltas, *replaced]
    snap.base = [f for f in snap.base if f not in set(replaced)]
    snap.base_rows += done.get["rows"] - before
    if done.get["rows"]:
        snap.base += _places(spark, target, folder, schema)
    snap.deltas, snap.delta_rows, snap.nameless = [], 0, 0
    _commit(spark, target, snap)
    for path in old:  # out of use for a whole cycle, so no reader has them open
        delete_path(spark, f"{_data(target)}/{path}")
    delete_path(spark, staging)
    return True


def _count(spark: SparkSession, target: str, folders: list, schema: T.StructType) -> int:
    """Rows of some folders, from the files' footers."""
    return _folders(spark, target, folders, schema).count() if folders else 0


def drop_partitions(spark: SparkSession, target: str, old) -> list[str]:
    """Take the partitions out for which ``old`` (of the partition folder's text) holds, by their names alone."""
    if is_log_table(spark, target):
        compact(spark, target)
        snap = snapshot(spark, target)
        gone = [f for f in snap.base if old(f.partition("/")[2])]
        if gone:
            snap.version += 1
            snap.base_rows -= _count(spark, target, gone, snap.fields)
            snap.base = [f for f in snap.base if f not in set(gone)]
            _commit(spark, target, snap)
            for f in gone:
                delete_path(spark, f"{_data(target)}/{f}")
        return sorted({f.partition("/")[2] for f in gone})
    found = [p for p in partition_folders(spark, target) if old(p)]
    for p in found:
        delete_path(spark, f"{target.rstrip('/')}/{p}")
    return found


def partition_folders(spark: SparkSession, base: str) -> list[str]:
    """Partition folders below a plain table, relative, by listing the folders (no file is opened)."""
    out, level = [], [""]
    while level:
        below = {p: [n for n, _ in list_folder(spark, f"{base.rstrip('/')}/{p}") if "=" in n and n[0] not in "_."] for p in level}
        out += [p for p, names in below.items() if p and not names]
        level = [f"{p}/{n}".lstrip("/") for p, names in below.items() for n in names]
    return sorted(out)


def drop_target(spark: SparkSession, target: str) -> None:
    """Delete a table's files and its log."""
    delete_path(spark, target)


def insert_new(spark: SparkSession, target: str, batch: DataFrame, key: str = DOC_KEY, order_by=(),
               partition_cols=PARTITION_COLS) -> dict:
    """Insert-if-absent by key (the redelivery filter of T3 as a batch step).

    Copies inside the batch collapse before the shuffle, then keys already stored in the batch's own
    partitions are dropped (a redelivered copy carries the same event time, hence the same partition)
    and the rest is appended.  A replayed batch finds its rows stored, so the step is idempotent.
    Rows without a key cannot be recognised again: they are not inserted, only counted
    (``rows_without_key``); callers quarantine them.
    """
    pcols = list(partition_cols)
    seen = Observation(f"seen_{uuid.uuid4().hex[:12]}")
    batch = batch.observe(seen, F.count_if(F.col(key).isNull()).alias("rows_without_key"))
    fresh = latest_per_key(batch.where(F.col(key).isNotNull()), key, list(order_by))
    staging = scratch_path(spark, "insert-staging")
    fresh.write.parquet(staging)
    fresh = read_table(spark, staging, batch.schema)
    if path_exists(spark, target):
        table = read_table(spark, target, batch.schema)
        held = _in_partitions(table, fresh.select(*pcols).distinct(), pcols).select(key)
        fresh = fresh.join(held, key, "left_anti")
    added = Observation(f"added_{uuid.uuid4().hex[:12]}")
    fresh.observe(added, F.count(F.lit(1)).alias("rows_added")).write.mode("append").partitionBy(*pcols).parquet(target)
    delete_path(spark, staging)
    return {**dict(added.get), **dict(seen.get)}


def upsert_bucketed(spark: SparkSession, target: str, batch: DataFrame, key: str,
                    buckets: int = DIMENSION_BUCKETS, order_by=()) -> dict:
    """K6 for a dimension keyed by id: the table is partitioned by a hash bucket of the key, so a compaction
    rewrites only the buckets that keys fall in.  Each bucket is written by one task; ``buckets`` is a choice
    of the table's owner (table bytes / wanted file size), and a key whose bucket changes with another
    ``buckets`` is still found by its key."""
    tagged = batch.withColumn(BUCKET, F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int"))
    return upsert(spark, target, tagged, key=key, order_by=order_by, partition_cols=(BUCKET,), cluster_by_partition=True)


def read_bucketed(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """Read a table written by ``upsert_bucketed`` without its bucket column."""
    return read_table(spark, target, schema)
