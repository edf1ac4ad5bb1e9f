"""Summaries that are kept beside the data, so that questions are answered without reading it again:
distinct sketches per day (A9, U2), order-independent digests (R1), a rollup that follows upserts (A2-A7)."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.upsert import (COMMIT, Snapshot, _folders, _newest, _same, files_with, is_log_table, read_commit,
                                         snapshot, upsert)
from ledgerline.schemas import CUST_KEY, DOC_KEY, PARTITION_COLS
from ledgerline.session import delete_path, list_folder, path_exists, read_text, scratch_path

# ---------------------------------------------------------------------------
# Distinct sketches
# ---------------------------------------------------------------------------
#: log2 of the buckets of a sketch: 2^14 buckets of 6 bits, a standard error of 0.8 %.
SKETCH_BITS = 14
SKETCHES = "sketch binary"


def store_sketches(df: DataFrame, path: str, key: str = CUST_KEY, by=PARTITION_COLS, mode: str = "append") -> None:
    """One sketch of the distinct keys per partition (nulls are no keys); the rows are read once, for good."""
    rows = df.where(F.col(key).isNotNull()).groupBy(*by).agg(F.hll_sketch_agg(F.col(key), F.lit(SKETCH_BITS)).alias("sketch"))
    rows.write.mode(mode).parquet(path)


def distinct_over(spark: SparkSession, path: str, ranges: DataFrame, by=PARTITION_COLS) -> DataFrame:
    """Estimated distinct keys of each range (start, stop: dates, both included), from the stored sketches of
    its days alone; a key of several days counts once.  Ranges without days have no row."""
    schema = ", ".join([*(f"{c} string" for c in by), SKETCHES])
    days = spark.read.schema(schema).parquet(path).withColumn("_day", F.to_date(F.concat_ws("-", *by)))
    asked = ranges.select("start", "stop", F.explode(F.sequence("start", "stop")).alias("_day"))
    inside = days.join(asked, "_day")
    return inside.groupBy("start", "stop").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).cast("long").alias("distinct_keys"))


# ---------------------------------------------------------------------------
# Digests
# ---------------------------------------------------------------------------
def digests(df: DataFrame, key: str, by=PARTITION_COLS) -> DataFrame:
    """Per partition the number of rows and two order-independent digests of the keys (exact sums of two
    64-bit hashes), summed in every task before the shuffle."""
    part = lambda seed: F.sum(F.xxhash64(F.lit(seed), F.col(key)).cast("decimal(20,0)"))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), part(1).alias("d1"), part(2).alias("d2"))


def differing(source: DataFrame, target: DataFrame, by=PARTITION_COLS) -> DataFrame:
    """Difference of two digest tables as a tree over the partition columns: the nodes that differ on the way
    from the root (``level`` 0, all columns null) to the partitions, children of differing nodes only."""
    both = source.select(*by, F.struct("n", "d1", "d2").alias("s")).join(
        target.select(*[F.col(c).alias(f"t_{c}") for c in by], F.struct("n", "d1", "d2").alias("t")),
        reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in by]), "full")
    leaf = both.select(*[F.coalesce(c, f"t_{c}").alias(c) for c in by], "s", "t")
    total = lambda side, c: F.coalesce(F.sum(f"{side}.{c}"), F.lit(0))
    equal = reduce(lambda a, b: a & b, [total("s", c) == total("t", c) for c in ("n", "d1", "d2")])
    unequal = F.count_if(~F.col("s").eqNullSafe(F.col("t")))  # a node differs where a leaf below does: digests cannot cancel out
    levels = [leaf.groupBy(*by[:k]).agg((~equal | (unequal > 0)).alias("_differs"), unequal.alias("differing_below"),
                                        total("s", "n").alias("source_rows"), total("t", "n").alias("target_rows"))
              .select(F.lit(k).alias("level"), *[F.col(c) if c in by[:k] else F.lit(None).cast("string").alias(c) for c in by],
                      "differing_below", "source_rows", "target_rows", "_differs") for k in range(len(by) + 1)]
    return reduce(DataFrame.unionByName, levels).where("_differs").drop("_differs")


def missing_by_digest(source: DataFrame, target: DataFrame, key: str, by=PARTITION_COLS) -> DataFrame:
    """R1 listing: source keys that the target lacks.  Partitions with equal digests are not read again: the
    others are named in the scan's filter (a row per differing partition on the driver)."""
    places = differing(digests(source, key, by), digests(target, key, by), by).where(F.col("level") == len(by)).select(*by)
    some = [tuple(r) for r in places.collect()]
    if not some:
        return source.select(key, *by).limit(0)
    named = reduce(lambda a, b: a | b, [reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(by, r)]) for r in some])
    held = target.select(key).distinct()  # a key may lie in another partition of the target
    return source.where(named).select(key, *by).join(held, key, "left_anti")


# ---------------------------------------------------------------------------
# Rollup
# ---------------------------------------------------------------------------
DIMENSIONS = [*PARTITION_COLS, "tipoTransacao", "tipoProdutoTransacao"]


def replaced_rows(spark: SparkSession, target: str, keys: DataFrame) -> DataFrame | None:
    """The live rows of some keys before they are upserted: only base files whose filters may hold one are read."""
    if not is_log_table(spark, target):
        return None
    snap = snapshot(spark, target)
    named = keys.select(*snap.keys).where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in snap.keys])).distinct()
    names = [f.name for f in snap.fields.fields]
    maybe = files_with(spark, target, snap, named)
    base = _folders(spark, target, maybe, snap.fields).select(*names)
    rows = base.join(named, _same(base, named, snap.keys), "left_semi")
    if snap.deltas:
        newest = _newest(spark, target, snap)
        rows = rows.join(newest.select(*snap.keys), snap.keys, "left_anti")
        own = newest.where(~F.col("_gone")).select(*names)
        rows = rows.unionByName(own.join(named, snap.keys, "left_semi").select(*names))
    return rows


def _counted(rows: DataFrame, sign: int, by, amount: str) -> DataFrame:
    cents = F.coalesce(F.col(amount).cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
    return rows.select(*by, F.lit(sign).cast("long").alias("n"), (cents * sign).cast("decimal(38,2)").alias("cents"))


def upsert_with_rollup(spark: SparkSession, target: str, rollup: str, batch: DataFrame, by=DIMENSIONS,
                       amount: str = "valorTotalTransacao", **options) -> dict:
    """An upsert that keeps counts and exact sums per ``by`` up to date: the rows it replaces are retracted,
    its own are added.

    The retractions are written before the commit, and the change, under the commit's number, after it; a
    writer lost in between is finished by the next call or by ``rolled_up``."""
    staged = scratch_path(spark, "rollup-batch")
    batch.write.parquet(staged)
    batch = spark.read.schema(batch.schema).parquet(staged)
    key = options.get("key", DOC_KEY)
    finish(spark, target, rollup, by, amount)
    old = replaced_rows(spark, target, batch.select(*([key] if isinstance(key, str) else key)))
    version = (snapshot(spark, target).version if old is not None else 0) + 1
    gone = _counted(batch.limit(0) if old is None else old, -1, by, amount)
    gone.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("cents").cast("decimal(38,2)").alias("cents")).write.mode("overwrite").parquet(
        f"{rollup.rstrip('/')}/_before-{version:08d}")
    stats = upsert(spark, target, batch, **options)
    finish(spark, target, rollup, by, amount)
    delete_path(spark, staged)
    return stats


def finish(spark: SparkSession, target: str, rollup: str, by=DIMENSIONS, amount: str = "valorTotalTransacao") -> None:
    """Write the changes of commits that are there but not in the rollup yet."""
    waiting = [n for n, _ in list_folder(spark, rollup) if n.startswith("_before-")]
    for name in waiting:
        number = name.removeprefix("_before-")
        note = read_text(spark, f"{target.rstrip('/')}/_log/{number}.json")
        if note is None:
            continue  # not committed: written again by the next upsert
        snap = Snapshot(**json.loads(note))
        schema = _rollup_schema(snap.fields, by)
        change = spark.read.schema(schema).parquet(f"{rollup.rstrip('/')}/{name}")
        for folder in {f.split("/")[0] for f in [*snap.base, *snap.deltas] if f.startswith(f"{COMMIT}={number}-")}:
            change = change.unionByName(_counted(read_commit(spark, target, folder, snap.fields), 1, by, amount))
        change.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("cents").cast("decimal(38,2)").alias("cents")).where(
            "n <> 0 OR cents <> 0").write.mode("overwrite").parquet(f"{rollup.rstrip('/')}/commit={number}")
        delete_path(spark, f"{rollup.rstrip('/')}/{name}")


def _rollup_schema(schema: T.StructType, by) -> T.StructType:
    return T.StructType([schema[c] for c in by] + [T.StructField("n", T.LongType()), T.StructField("cents", T.DecimalType(38, 2))])


def rolled_up(spark: SparkSession, target: str, rollup: str, by=DIMENSIONS) -> DataFrame:
    """(by, n, cents) of the live rows, from the stored changes alone."""
    finish(spark, target, rollup, by)
    schema = _rollup_schema(snapshot(spark, target).fields, by)
    if not path_exists(spark, rollup):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", rollup).parquet(rollup)
    return rows.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("cents").cast("decimal(38,2)").alias("cents")).where("n <> 0")


def terms_of(rolled: DataFrame, field: str, size: int = 10) -> DataFrame:
    """A2 from the rollup: count per value, largest first, ties by value, nulls skipped."""
    count: Column = F.sum("n").alias("doc_count")
    return rolled.where(F.col(field).isNotNull()).groupBy(F.col(field).alias("key")).agg(count).orderBy(
        F.desc("doc_count"), "key").limit(size)
