"""JSON sources.

Transactions are JSON Lines under ``year=YYYY/month=MM/day=DD`` directories.
Reads always declare the schema (no inference pass over the files).  Day and
range scans list only the wanted day directories (``basePath`` keeps the
partition columns, declared as strings so zero padding survives): the file
listing does not grow with the history kept under the base path, and a
missing day yields zero rows instead of an analysis error (D7, D8).  The
whole-tree scan lists everything, as a catalog crawler would.
"""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import parse_ts
from ledgerline.schemas import (CORRUPT_COL, PARTITION_COLS, TXN_COLS, TXN_RAW,
                                TXN_RAW_WITH_CORRUPT, TXN_REQUIRED)
from ledgerline.session import delete_path, path_exists, scratch_path


def read_jsonl(spark: SparkSession, base: str, schema: T.StructType = TXN_RAW) -> DataFrame:
    """Raw JSON Lines tree; PERMISSIVE, corrupt lines kept when the schema has the column."""
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    if CORRUPT_COL in schema.fieldNames():
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    return reader.json(base)


def day_predicate(year: str, month: str, day: str):
    return (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day)


def range_predicate(start: str, end: str):
    """Inclusive ``yyyy-MM-dd`` bounds on the partition columns."""
    key = F.concat_ws("-", "year", "month", "day")
    return key.between(F.lit(start), F.lit(end))


def parse_raw(raw: DataFrame, keep=PARTITION_COLS) -> DataFrame:
    """Typed transactions: timestamp text parsed in UTC; other fields as read."""
    cols = [parse_ts(c).alias(c) if c == "data_completa_transacao" else F.col(c) for c in TXN_COLS]
    return raw.select(*cols, *keep)


def scan_tree(spark: SparkSession, base: str) -> DataFrame:
    """Every partition, partition columns from the directory names."""
    return parse_raw(read_jsonl(spark, base))


def day_path(base: str, year: str, month: str, day: str) -> str:
    return f"{base.rstrip('/')}/year={year}/month={month}/day={day}"


def read_days(spark: SparkSession, base: str, days, schema: T.StructType = TXN_RAW) -> DataFrame:
    """Raw rows of the given (year, month, day) keys; only their directories are listed."""
    paths = [day_path(base, *d) for d in days]
    present = [p for p in paths if path_exists(spark, p)]
    if not present:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", base.rstrip("/")).option("mode", "PERMISSIVE")
    if CORRUPT_COL in schema.fieldNames():
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    return reader.json(present)


def days_between(start: str, end: str) -> list[tuple[str, str, str]]:
    """Zero-padded (year, month, day) keys of every date in [start, end]."""
    d0, d1 = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    return [((d0 + dt.timedelta(days=i)).strftime("%Y"), (d0 + dt.timedelta(days=i)).strftime("%m"),
             (d0 + dt.timedelta(days=i)).strftime("%d")) for i in range((d1 - d0).days + 1)]


def scan_day(spark: SparkSession, base: str, year: str, month: str, day: str) -> DataFrame:
    """One day, reading only its directory."""
    return parse_raw(read_days(spark, base, [(year, month, day)]))


def scan_range(spark: SparkSession, base: str, start: str, end: str) -> DataFrame:
    """Days in [start, end], both inclusive, reading only their directories."""
    return parse_raw(read_days(spark, base, days_between(start, end)))


def quarantine_reason():
    """First failing rule of a raw row, or null when it is valid."""
    reason = F.when(F.col(CORRUPT_COL).isNotNull(), F.lit("json"))
    for c in TXN_REQUIRED:
        if c != "data_completa_transacao":
            reason = reason.when(F.col(c).isNull(), F.lit({"codigo_lancamento": "id",
                                                          "valor_total_transacao": "amount"}[c]))
    return reason.when(parse_ts("data_completa_transacao").isNull(), F.lit("timestamp"))


def split_valid(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed good rows, raw quarantined rows + ``reason``).

    ``raw`` must come from a schema with ``_corrupt_record``.  Both outputs
    derive from one tagged projection; callers writing both should persist
    or checkpoint it once.
    """
    tagged = raw.withColumn("reason", quarantine_reason())
    return valid_rows(tagged), tagged.where(F.col("reason").isNotNull())


@contextmanager
def parsed_once(raw: DataFrame):
    """(good, bad) of raw rows that several writes read: tagged with their reason and written once to
    the shared folder (the files are parsed once, lost executors take nothing along), deleted at the end."""
    spark = raw.sparkSession
    path = scratch_path(spark, "tagged")
    raw.withColumn("reason", quarantine_reason()).write.parquet(path)
    tagged = spark.read.schema(T.StructType(raw.schema.fields + [T.StructField("reason", T.StringType())])).parquet(path)
    try:
        yield valid_rows(tagged), tagged.where(F.col("reason").isNotNull())
    finally:
        delete_path(spark, path)


def valid_rows(tagged: DataFrame) -> DataFrame:
    """Typed good rows of rows tagged with ``reason``."""
    return parse_raw(tagged.where(F.col("reason").isNull()),
                     keep=[c for c in PARTITION_COLS if c in tagged.columns])


def scan_with_quarantine(spark: SparkSession, base: str, predicate=None):
    raw = read_jsonl(spark, base, TXN_RAW_WITH_CORRUPT)
    if predicate is not None:
        raw = raw.where(predicate)
    return split_valid(raw)


def scan_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files each holding one JSON array (one file per task, not splittable)."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def sample_n(df: DataFrame, n: int, order_by) -> DataFrame:
    """First ``n`` rows in a declared order (TakeOrderedAndProject, no full sort)."""
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*order_by).limit(n)


def evolve_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """S3: by-name union; new columns are added, removed columns are kept (null)."""
    return old.unionByName(new, allowMissingColumns=True)
