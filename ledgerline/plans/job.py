"""The daily job: scan one day, quarantine, enrich, upsert, report."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import pct_rounded
from ledgerline.operators.documents import to_document
from ledgerline.operators.enrich import enrich
from ledgerline.operators.sinks import catalog_location, compact, ensure_table, read_commit, register_partitions, upsert
from ledgerline.schemas import DOCS_SCHEMA, PARTITION_COLS, TXN_RAW_WITH_CORRUPT
from ledgerline.session import configure
from ledgerline.sources.json_files import parsed_once, read_days


def run_day(spark: SparkSession, base: str, year: str, month: str, day: str, customers: DataFrame,
            target: str, quarantine: str | None = None, table: str | None = None) -> dict:
    """Process one day of ``base`` into ``target``; returns the run report.

    A day without rows stops before touching the target (status ``empty``).
    Bad rows are split off with a reason, never fatal; a failing write fails
    the job (no swallowed errors, D2/D14).  The day's files are parsed once; counts are observed
    while quarantine and documents are written, so nothing is scanned twice for the report.
    Quarantined rows go to ``quarantine`` (default: ``<target>_quarantine``), one folder per day.
    ``table`` names the target in the catalog: it is created with the declared schema if absent (K1);
    the day's delta is folded into the base and the partitions that this wrote are registered.
    """
    configure(spark)
    started = dt.datetime.now(dt.timezone.utc)
    raw = read_days(spark, base, [(year, month, day)], TXN_RAW_WITH_CORRUPT)
    report = {"year": year, "month": month, "day": day, "status": "empty", "rows_read": 0,
              "rows_written": 0, "rows_matched": 0, "rows_quarantined": 0}
    if raw.isEmpty():
        report.update(started_on=started, completed_on=dt.datetime.now(dt.timezone.utc))
        return report
    if table is not None:
        ensure_table(spark, table, DOCS_SCHEMA, catalog_location(target), PARTITION_COLS)
    quarantine = quarantine or f"{target.rstrip('/')}_quarantine"
    dead = Observation(f"quarantine_{uuid.uuid4().hex[:12]}")
    with parsed_once(raw) as (good, bad):
        (bad.observe(dead, F.count(F.lit(1)).alias("rows_quarantined"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")     # this day only
         .partitionBy(*PARTITION_COLS).json(quarantine))
        docs = to_document(enrich(good, customers), keep=PARTITION_COLS)
        stats = upsert(spark, target, docs, order_by=["dataCompletaTransacao", "valorTotalTransacao"],
                       batch_metrics={"rows_matched": F.col("nomeTitularConta").isNotNull()})
    if table is not None:
        compact(spark, target)
        register_partitions(spark, table, target)
    n_bad = dead.get["rows_quarantined"]
    completed = dt.datetime.now(dt.timezone.utc)
    report.update(status="succeeded", rows_read=stats["rows_in_batch"] + n_bad, rows_quarantined=n_bad,
                  rows_written=stats["rows_from_batch"], rows_matched=stats["rows_matched"],
                  quarantine=quarantine, started_on=started, completed_on=completed,
                  seconds=(completed - started).total_seconds())
    return report


def run_days(spark: SparkSession, base: str, days, customers: DataFrame, target: str, quarantine: str | None = None) -> list[dict]:
    """Process many days (year, month, day) of ``base`` in one pass: one parse, one enrichment, one upsert.

    Returns a report per day, as ``run_day`` does; days without rows are ``empty``.  A day's ``seconds`` are
    its rows' share of the pass (equal shares where no day has rows)."""
    configure(spark)
    started = dt.datetime.now(dt.timezone.utc)
    quarantine = quarantine or f"{target.rstrip('/')}_quarantine"
    read, stored = {}, {}
    with parsed_once(read_days(spark, base, days, TXN_RAW_WITH_CORRUPT)) as (good, bad):
        per_day = lambda df, *more: {tuple(r)[:3]: tuple(r)[3:] for r in df.groupBy(*PARTITION_COLS).agg(
            F.count(F.lit(1)).alias("n"), *more).collect()}  # a row per day
        wrong = per_day(bad)
        if wrong:
            (bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION_COLS).json(quarantine))
        read = per_day(good)
        if read:
            docs = to_document(enrich(good, customers), keep=PARTITION_COLS)
            stats = upsert(spark, target, docs, order_by=["dataCompletaTransacao", "valorTotalTransacao"])
            stored = per_day(read_commit(spark, target, stats["commit"], DOCS_SCHEMA), F.count("nomeTitularConta").alias("matched"))
    completed = dt.datetime.now(dt.timezone.utc)
    seconds, total = (completed - started).total_seconds(), sum(n for (n,) in read.values())
    out = []
    for day in days:
        n, n_bad = read.get(day, (0,))[0], wrong.get(day, (0,))[0]
        written, matched = stored.get(day, (0, 0))
        out.append({"year": day[0], "month": day[1], "day": day[2], "status": "succeeded" if n + n_bad else "empty",
                    "rows_read": n + n_bad, "rows_written": written, "rows_matched": matched, "rows_quarantined": n_bad,
                    "quarantine": quarantine, "started_on": started, "completed_on": completed,
                    "seconds": seconds * (n / total if total else 1 / len(days))})
    return out


def report_frame(spark: SparkSession, report: dict) -> DataFrame:
    """One-row DataFrame of a run report (the run ledger's input)."""
    cols = ["year", "month", "day", "status", "rows_read", "rows_written", "rows_matched",
            "rows_quarantined"]
    df = spark.createDataFrame([tuple(report[c] for c in cols)],
                               "year string, month string, day string, status string, rows_read long, "
                               "rows_written long, rows_matched long, rows_quarantined long")
    return df.withColumn("match_rate", pct_rounded("rows_matched", "rows_written", 2))
