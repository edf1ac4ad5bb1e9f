"""Structured Streaming (T1-T4): the batch transforms on arriving files.

Every stream reads lines with the corrupt-record column and splits them: bad rows (unreadable lines,
null ids, missing amounts, unreadable times) go to a quarantine folder with their reason, never away.
Quarantine and side folders are keyed by the micro-batch's number and overwritten, so a replayed
micro-batch changes nothing.

* T1 new-file ingestion: ``foreachBatch`` keyed upsert.
* T2 stream-static enrichment: good and bad rows by micro-batch, one query.
* T3 redelivery suppression: insert-if-absent per micro-batch; rows older than the watermark (the
  greatest event time of earlier micro-batches less the delay) go to a late folder instead.
* T4 tumbling volume: a micro-batch's sums are added to the stored windows of its dates.
Checkpoints live in the shared folder the caller passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.documents import to_document
from ledgerline.operators.enrich import enrich
from ledgerline.operators.sinks import insert_new, read_table, upsert
from ledgerline.operators.upsert import is_log_table
from ledgerline.schemas import PARTITION_COLS, TXN_RAW_WITH_CORRUPT
from ledgerline.session import delete_path, list_folder, read_text, scratch_path, write_text
from ledgerline.sources.json_files import parsed_once

DOC_ORDER = ["dataCompletaTransacao", "valorTotalTransacao"]


def stream_source(spark: SparkSession, base: str, schema: T.StructType = TXN_RAW_WITH_CORRUPT,
                  max_files_per_trigger: int | None = None, archive_dir: str | None = None) -> DataFrame:
    """Streaming read of the JSON Lines tree (partition columns from directory names).

    The file source lists the tree every trigger; with ``archive_dir`` processed
    files are moved there (``cleanSource=archive``; a batch's files move when the
    next batch commits), so the listing stays the size of the backlog instead
    of the whole history.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if "_corrupt_record" in schema.fieldNames():
        reader = reader.option("columnNameOfCorruptRecord", "_corrupt_record")
    return reader.json(base)


def _run(writer, checkpoint: str, available_now: bool = True):
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="900 seconds")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def _of_epoch(base: str, epoch_id: int) -> str:
    return f"{base.rstrip('/')}/epoch={epoch_id}"


def quarantined(bad: DataFrame, quarantine: str, epoch_id: int) -> None:
    """Bad rows of one micro-batch; a replay overwrites them."""
    bad.write.mode("overwrite").json(_of_epoch(quarantine, epoch_id))


def stream_ingest(spark: SparkSession, base: str, target: str, checkpoint: str, customers: DataFrame,
                  quarantine: str, available_now: bool = True, max_files_per_trigger: int | None = None,
                  archive_dir: str | None = None):
    """Run the daily job's transform on every new file batch."""
    raw = stream_source(spark, base, TXN_RAW_WITH_CORRUPT, max_files_per_trigger, archive_dir)

    def per_batch(batch: DataFrame, epoch_id: int):
        with parsed_once(batch) as (good, bad):
            quarantined(bad, quarantine, epoch_id)
            upsert(batch.sparkSession, target, to_document(enrich(good, customers), keep=PARTITION_COLS), order_by=DOC_ORDER)

    return _run(raw.writeStream.foreachBatch(per_batch), checkpoint, available_now)


def stream_enrich(spark: SparkSession, base: str, out: str, checkpoint: str, customers: DataFrame,
                  quarantine: str, available_now: bool = True, max_files_per_trigger: int | None = None):
    """Stream-static left join.  One query and one parse: good rows go to ``out``, bad ones to the
    quarantine, both by the micro-batch's number (a replay overwrites them), under one trigger and one handle.

    A micro-batch is an ordinary DataFrame, so a customer table too large to broadcast is joined by
    sort-merge, and AQE splits a hot account."""
    raw = stream_source(spark, base, max_files_per_trigger=max_files_per_trigger)

    def per_batch(batch: DataFrame, epoch_id: int):
        with parsed_once(batch) as (good, bad):
            quarantined(bad, quarantine, epoch_id)
            docs = to_document(enrich(good, customers), keep=PARTITION_COLS)
            docs.write.mode("overwrite").partitionBy(*PARTITION_COLS).parquet(_of_epoch(out, epoch_id))

    return _run(raw.writeStream.foreachBatch(per_batch), checkpoint, available_now)


#: Notes of the greatest event time that are kept; only the last one before a micro-batch is read.
KEPT_MARKS = 3


def _watermark(spark: SparkSession, side: str, epoch_id: int) -> str | None:
    """Greatest event time of the earlier micro-batches (ISO text), from the last of their notes."""
    earlier = [int(n) for n, _ in list_folder(spark, side) if n.isdigit() and int(n) < epoch_id]
    return read_text(spark, f"{side}/{max(earlier)}") if earlier else None


def _mark(spark: SparkSession, side: str, epoch_id: int, newest: str) -> None:
    write_text(spark, f"{side}/{epoch_id}", newest)
    for name, _ in list_folder(spark, side):
        if name.isdigit() and int(name) <= epoch_id - KEPT_MARKS:
            delete_path(spark, f"{side}/{name}")


def stream_dedupe_into(spark: SparkSession, base: str, target: str, checkpoint: str, quarantine: str,
                       late: str | None = None, delay: str = "1 hour", key: str = "codigo_lancamento",
                       ts: str = "data_completa_transacao", available_now: bool = True,
                       max_files_per_trigger: int | None = None):
    """One row per key.  Per micro-batch, copies collapse before the shuffle and only keys not yet
    stored in the batch's day partitions are appended (``insert_new``); there is no state store, the
    target itself tells replays and redeliveries, however late.

    With ``late``, rows older than the watermark are not inserted but written there (every copy, by
    micro-batch), so kept + late + quarantined rows account for the whole source.  The watermark is kept in
    one small note per micro-batch, of which the last few stay."""
    raw = stream_source(spark, base, TXN_RAW_WITH_CORRUPT, max_files_per_trigger)
    side = f"{checkpoint}/newest"

    def per_batch(batch: DataFrame, epoch_id: int):
        session = batch.sparkSession
        with parsed_once(batch) as (good, bad):
            quarantined(bad, quarantine, epoch_id)
            if late is not None:
                before = _watermark(session, side, epoch_id)
                own = good.agg(F.max(ts).cast("string")).first()[0]
                if before:
                    old = F.col(ts) < F.lit(before).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
                    good.where(old).write.mode("overwrite").parquet(_of_epoch(late, epoch_id))
                    good = good.where(~old)
                if own or before:
                    _mark(session, side, epoch_id, max(own or "", before or ""))
            insert_new(session, target, good, key=key, order_by=[ts])

    return _run(raw.writeStream.foreachBatch(per_batch), checkpoint, available_now)


def window_sums(txn: DataFrame, period: str = "900 seconds", by: str = "tipo_transacao",
                ts: str = "data_completa_transacao", value: str = "valor_total_transacao") -> DataFrame:
    """Count and exact sum per type (none: the empty text) and tumbling window, with the window's date."""
    start = F.window(F.col(ts).cast("timestamp"), period).start.cast("timestamp_ntz")
    sums = txn.groupBy(F.coalesce(by, F.lit("")).alias(by), start.alias("window_start")).agg(
        F.count(F.lit(1)).alias("n_transactions"),
        F.coalesce(F.sum(F.col(value).cast("decimal(18,2)")), F.lit(0)).cast("decimal(38,2)").alias("cents"))
    return sums.withColumn("window_date", F.date_format("window_start", "yyyy-MM-dd"))


def stream_tumbling(spark: SparkSession, base: str, target: str, checkpoint: str, quarantine: str,
                    period: str = "900 seconds", by: str = "tipo_transacao", available_now: bool = True,
                    max_files_per_trigger: int | None = None):
    """T4: count and exact sum per type and tumbling window, late rows included; read with ``window_totals``.

    The view is maintained incrementally: a micro-batch's sums are added to the stored windows of the dates it
    touched and upserted.  A window keeps its state before the micro-batch that changed it last, so a replay
    of that one adds to the state before it instead of counting twice.  Only the folders of the touched dates
    are listed and read, whatever the history holds."""
    raw = stream_source(spark, base, TXN_RAW_WITH_CORRUPT, max_files_per_trigger)
    keys = [by, "window_start"]

    def per_batch(batch: DataFrame, epoch_id: int):
        session = batch.sparkSession
        with parsed_once(batch) as (good, bad):
            quarantined(bad, quarantine, epoch_id)
            window_sums(good, period, by).write.parquet(own_at := scratch_path(session, "window-sums"))
        own = session.read.parquet(own_at)
        dates = {r[0] for r in own.select("window_date").distinct().collect()}  # days
        old = stored_windows(session, target, own, dates)
        again = F.col("epoch") == epoch_id
        base_of = lambda c: F.coalesce(F.when(again, F.col(f"{c}_before")).otherwise(F.col(f"{c}_now")), F.lit(0))
        state = old.select(*keys, *[base_of(c).alias(f"{c}_old") for c in ("n", "cents")])
        total = lambda c, kind: (F.col(c) + F.coalesce(f"{c}_old", F.lit(0))).cast(kind)
        merged = own.withColumnRenamed("n_transactions", "n").join(state, keys, "left").select(
            *keys, "window_date", total("n", "long").alias("n_now"), total("cents", "decimal(38,2)").alias("cents_now"),
            F.coalesce("n_old", F.lit(0)).cast("long").alias("n_before"), F.coalesce("cents_old", F.lit(0)).cast("decimal(38,2)").alias("cents_before"),
            F.lit(epoch_id).cast("long").alias("epoch"))
        upsert(session, target, merged, key=keys, partition_cols=("window_date",))
        delete_path(session, own_at)

    return _run(raw.writeStream.foreachBatch(per_batch), checkpoint, available_now)


def stored_windows(spark: SparkSession, target: str, own: DataFrame, dates: set) -> DataFrame:
    """The stored windows of some dates; other dates' folders are not listed."""
    by, start = own.columns[0], own.schema["window_start"]
    schema = T.StructType([own.schema[by], start, T.StructField("n_now", T.LongType()), T.StructField("cents_now", T.DecimalType(38, 2)),
                           T.StructField("n_before", T.LongType()), T.StructField("cents_before", T.DecimalType(38, 2)),
                           T.StructField("epoch", T.LongType()), T.StructField("window_date", T.StringType())])
    if not is_log_table(spark, target):
        return spark.createDataFrame([], schema)
    folders = {f"window_date={d}" for d in dates}
    return read_table(spark, target, schema, only=folders.__contains__).where(F.col("window_date").isin(sorted(dates)))


def window_totals(spark: SparkSession, target: str) -> DataFrame:
    """The windows of ``stream_tumbling``: type, window_start, n_transactions, sum_valor."""
    rows = read_table(spark, target)
    return rows.select(rows.columns[0], "window_start", F.col("n_now").alias("n_transactions"), F.col("cents_now").cast("double").alias("sum_valor"))


def run_append(df: DataFrame, out: str, checkpoint: str, partition_cols=PARTITION_COLS,
               available_now: bool = True):
    writer = df.writeStream.format("parquet").outputMode("append").option("path", out)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    return _run(writer, checkpoint, available_now)
