"""Sinks (K1, K3-K5, K7-K9), last-write-wins union (U1) and batching; the keyed upsert (K2, K6) and
the latest row per key (W1) are in ``operators/upsert.py`` and re-exported here."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import md5_bucket, money_sum, time_text
from ledgerline.schemas import (BULK_BATCH_DOCS, DOC_KEY, PARTITION_COLS, RETENTION_DAYS,
                                TXN_COLS)
from ledgerline.operators.upsert import (COMMIT, compact, delete_keys, drop_partitions, drop_target,  # noqa: F401
                                         insert_new, latest_per_key, read_bucketed, read_commit, read_table, recover,
                                         snapshot, table_schema, upsert, upsert_bucketed)


# ---------------------------------------------------------------------------
# Last write wins
# ---------------------------------------------------------------------------
def union_last_wins(batches: list[DataFrame], key, order_by=()) -> DataFrame:
    """Union of responses; a later batch replaces an earlier one per key."""
    tagged = [b.withColumn("_batch", F.lit(i)) for i, b in enumerate(batches)]
    allb = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return latest_per_key(allb, key, ["_batch", *order_by])


# ---------------------------------------------------------------------------
# Writers
# ---------------------------------------------------------------------------
def spread(df: DataFrame, partition_cols, key: str, files_per_partition: int | str | None) -> DataFrame:
    """Choose how rows reach the writer tasks of a partitioned write.

    * ``None`` (default): keep the input partitioning, no shuffle.  Each task
      writes one file per partition value it holds, which for time-clustered
      input (the normal case) is one or two files of split size.
    * ``"range"``: range-partition on (partition columns, key) after sampling:
      a day holding a third of the data is cut into many equal tasks.
    * ``int``: hash (partition columns, xxhash64(key) mod n): at most n files per
      partition value, for small inputs that should not fragment.
    """
    if files_per_partition is None:
        return df
    if files_per_partition == "range":
        return df.repartitionByRange(*[F.col(c) for c in partition_cols], F.col(key))
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(int(files_per_partition)))
    return df.repartition(*[F.col(c) for c in partition_cols], bucket)


def write_jsonl(lines: DataFrame, base: str, partition_cols=PARTITION_COLS,
                key: str | None = None, files_per_partition: int | str | None = None,
                mode: str = "errorifexists"):
    """Text lines (column ``value``) partitioned into ``year=/month=/day=`` folders."""
    if key is not None:
        lines = spread(lines, partition_cols, key, files_per_partition)
    lines.select("value", *partition_cols).write.mode(mode).partitionBy(*partition_cols).text(base)


def txn_line(df: DataFrame | None = None, overrides: dict | None = None):
    """One producer JSON object per transaction, time as ``yyyy-MM-dd'T'HH:mm:ss'Z'``.

    ``overrides`` replaces field expressions (a null value drops the key, as
    the producer omits absent fields).
    """
    overrides = overrides or {}
    cols = []
    for c in TXN_COLS:
        if c in overrides:
            cols.append(overrides[c].alias(c))
        elif c == "data_completa_transacao":
            cols.append(time_text(c).alias(c))
        else:
            cols.append(F.col(c))
    return F.to_json(F.struct(*cols))


def write_partitioned_jsonl(txn: DataFrame, base: str, files_per_partition: int | str | None = None,
                            mode: str = "errorifexists") -> str:
    """K5: date-partitioned JSON Lines with zero-padded keys from the event time."""
    lines = txn.select(txn_line().alias("value"), "codigo_lancamento", *PARTITION_COLS)
    write_jsonl(lines, base, key="codigo_lancamento", files_per_partition=files_per_partition,
                mode=mode)
    return base


#: Default number of files of the JSON-array writer.
ARRAY_FILES = 8


def write_json_array(df: DataFrame, path: str, num_files: int = ARRAY_FILES) -> str:
    """One JSON array per output file (the saved-customers format).

    An array file cannot be split when read back, so ``num_files`` is the parallelism of writer and
    reader; large tables pass more.  Each task streams its rows: ``[`` before the first element,
    ``,`` before the others, ``]`` after the last; memory stays at one Arrow batch.
    """
    lines = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))
    lines = lines.repartition(num_files)

    def bracket(batches):
        started = False
        for pdf in batches:
            if len(pdf) == 0:
                continue
            prefix = pd.Series([","] * len(pdf), index=pdf.index)
            if not started:
                prefix.iloc[0] = "["
                started = True
            yield pd.DataFrame({"value": prefix + pdf["value"]})
        if started:
            yield pd.DataFrame({"value": ["]"]})

    lines.mapInPandas(bracket, "value string").write.text(path)
    return path


# ---------------------------------------------------------------------------
# Table create / drop
# ---------------------------------------------------------------------------
def ensure_table(spark: SparkSession, name: str, schema: T.StructType, location: str,
                 partition_cols=()) -> bool:
    """K1: create the target with a declared schema if absent; never touch an existing one.

    Returns True when the table was created by this call.
    """
    if spark.catalog.tableExists(name):
        return False
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{parts} LOCATION '{location}'")
    return True


#: Folder, always empty, that a log table's catalog entry names; its partitions lie elsewhere.
CATALOG = "/_catalog"


def catalog_location(target: str) -> str:
    return target.rstrip("/") + CATALOG


def register_partitions(spark: SparkSession, name: str, target: str) -> list[str]:
    """Point the catalog's partitions at the folders that the newest commit of a log table wrote, and drop
    those it emptied; nothing else is listed or changed.  The catalog shows the base (call ``compact`` before)."""
    snap = snapshot(spark, target)
    spec = lambda place: ", ".join(_partition_value(part) for part in place.split("/"))
    live = {f.partition("/")[2]: f for f in snap.base}
    new = [p for p, f in live.items() if f.startswith(f"{COMMIT}={snap.version:08d}-")]
    for place in new:
        location = f"{target.rstrip('/')}/data/{live[place]}".replace("'", "\\'")
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec(place)}) LOCATION '{location}'")
        spark.sql(f"ALTER TABLE {name} PARTITION ({spec(place)}) SET LOCATION '{location}'")
    for place in {f.partition("/")[2] for f in snap.garbage} - {""} - set(live):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec(place)})")
    spark.catalog.refreshTable(name)
    return sorted(new)


def _partition_value(part: str) -> str:
    column, _, value = part.partition("=")
    if value == "__HIVE_DEFAULT_PARTITION__":
        return f"`{column}` = NULL"
    text = unquote(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"`{column}` = '{text}'"


def drop_table(spark: SparkSession, name: str, purge_location: bool = True) -> bool:
    """K7: delete the target (catalog entry and, for our external tables, its files)."""
    if not spark.catalog.tableExists(name):
        return False
    location = None
    if purge_location:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
        location = rows[0]["data_type"] if rows else None
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if location:
        drop_target(spark, location.removesuffix(CATALOG))
    return True


# ---------------------------------------------------------------------------
# Bulk batches, write accounting, retention
# ---------------------------------------------------------------------------
#: Default number of id buckets that a partition's documents are numbered in.
BATCH_BUCKETS = 16


def assign_batches(docs: DataFrame, size: int = BULK_BATCH_DOCS, within=PARTITION_COLS,
                   buckets: int = BATCH_BUCKETS, key: str = DOC_KEY) -> DataFrame:
    """K4: number documents into bulk batches of at most ``size``.

    Numbering needs an order, so it runs inside (partition, md5 bucket of the id) groups, each sorted
    by one task: ``buckets`` is the number of tasks a single partition can use.  It is a parameter and
    does not follow the data, so a document's batch depends on its group only.
    """
    from pyspark.sql import Window
    within = list(within)
    w = Window.partitionBy(*within, "bucket").orderBy(key)
    numbered = (docs.select(key, *within, md5_bucket(key, buckets).alias("bucket"))
                .withColumn("batch_no", F.floor((F.row_number().over(w) - 1) / F.lit(size)).cast("long")))
    return numbered.groupBy(*within, "bucket", "batch_no").agg(F.count(F.lit(1)).alias("n_docs"))


def write_with_metrics(docs: DataFrame, write, matched_col: str = "nomeTitularConta",
                       amount_col: str = "valorTotalTransacao") -> dict:
    """K9: counts observed while the write runs (no second pass, D4)."""
    obs = Observation("write_metrics")
    observed = docs.observe(obs, F.count(F.lit(1)).alias("rows_written"),
                            F.count(matched_col).alias("rows_matched"),
                            money_sum(amount_col).alias("total_valor"))
    write(observed)
    return dict(obs.get)


def in_prefix(prefix: str, partition_cols=PARTITION_COLS):
    """Whether a partition's path (``year=YYYY/month=MM/day=DD``) starts with ``prefix``."""
    path = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in partition_cols])
    return path.startswith(F.lit(prefix))


def retention_tiers(df: DataFrame, as_of: str, partition_cols=PARTITION_COLS, prefix: str = "") -> DataFrame:
    """K8: storage tier per date partition by age (90 / 180 / 365 days), for partitions whose path
    starts with ``prefix``."""
    df = df.where(in_prefix(prefix, partition_cols)) if prefix else df
    pdate = F.make_date(*[F.col(c).cast("int") for c in partition_cols])
    age = F.datediff(F.lit(as_of).cast("date"), pdate)
    tier = (F.when(age >= RETENTION_DAYS["expire"], "expired")
            .when(age >= RETENTION_DAYS["archive"], "archive")
            .when(age >= RETENTION_DAYS["infrequent_access"], "infrequent_access")
            .otherwise("standard"))
    return (df.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("n_rows"))
            .select(*partition_cols, age.alias("age_days"), tier.alias("tier"), "n_rows"))


def expire(spark: SparkSession, target: str, as_of: str, partition_cols=PARTITION_COLS, prefix: str = "") -> list[tuple]:
    """K8: delete date partitions at least 365 days old below ``prefix``; returns the removed keys.

    Partitions are told by their folders' names; no row is read.  A folder that names no date stays."""
    day = dt.date.fromisoformat(as_of)

    def old(folder: str) -> bool:
        try:
            age = (day - dt.date(*(int(part.split("=", 1)[1]) for part in folder.split("/")))).days
        except (ValueError, TypeError):
            return False
        return age >= RETENTION_DAYS["expire"] and folder.startswith(prefix)

    return [tuple(part.split("=", 1)[1] for part in folder.split("/")) for folder in drop_partitions(spark, target, old)]
