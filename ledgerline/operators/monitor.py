"""Operational monitoring over tables.

Metric statistics are tumbling-window aggregates; alarm evaluation works on
the aggregated buckets (one row per metric and period) by aggregation alone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import money_avg, money_sum
from ledgerline.operators.sinks import latest_per_key
from ledgerline.schemas import ALARM_RULES, DPU_PER_RUN, PARTITION_COLS, PRICE_PER_DPU_HOUR

_STATS = {
    "sum": lambda c: money_sum(c),
    "avg": lambda c: money_avg(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "count": lambda c: F.count(c).cast("double"),
}
_CMP = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b,
        "<=": lambda a, b: a <= b}


def metric_series(txn: DataFrame, metric: str = "tipo_transacao", ts: str = "data_completa_transacao",
                  value: str = "valor_total_transacao") -> DataFrame:
    """(metric, ts, value) rows from any table with a time and a measure."""
    return txn.select(F.col(metric).alias("metric"), F.col(ts).alias("ts"), F.col(value).alias("value"))


def _bucketed(series: DataFrame, period_s: int):
    return series.groupBy("metric", F.window("ts", f"{period_s} seconds").start.alias("bucket_start"))


def metric_stats(series: DataFrame, period_s: int = 300, start: str | None = None,
                 end: str | None = None) -> DataFrame:
    """Count, sum, min, max, average per metric and tumbling period, optionally
    over [start, end) (a time-range filter that reaches the scan)."""
    if start is not None:
        series = series.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        series = series.where(F.col("ts") < F.lit(end).cast("timestamp_ntz"))
    return _bucketed(series, period_s).agg(
        F.count(F.lit(1)).alias("n_points"), money_sum("value").alias("sum_value"),
        F.min("value").alias("min_value"), F.max("value").alias("max_value"),
        money_avg("value").alias("avg_value"))


def bucket_stats(series: DataFrame, period_s: int) -> DataFrame:
    """Every statistic of every (metric, period bucket) in one aggregate.

    Rules sharing a period build this identical subtree, so Spark reuses its
    exchange: one scan and one shuffle per period, not per rule.
    """
    return _bucketed(series, period_s).agg(*[fn("value").alias(name) for name, fn in _STATS.items()])


def evaluate_alarm(series: DataFrame, rule: str, metric: str, statistic: str, period_s: int,
                   comparison: str, threshold: float, periods: int) -> DataFrame:
    """Buckets where the alarm of one metric is in ALARM.

    A bucket alarms when it and the ``periods - 1`` buckets before it all
    breach.  Adjacency is by bucket number, not by row: only breaching
    buckets are kept, so a missing bucket breaks the run (missing data is
    not breaching).
    """
    return evaluate_rules(series, {rule: (metric, statistic, period_s, comparison, threshold, periods)})


def evaluate_rules(series: DataFrame, rules: dict = ALARM_RULES) -> DataFrame:
    """W2 for a set of rules, each on its own metric: one scan and one aggregate per distinct period.

    Only the rules' metrics are read.  All rules of a period share the same bucket statistics; a
    breaching bucket counts towards itself and the buckets after it within the rule's periods, and a
    bucket that collects as many as the rule asks for alarms.  No group is larger than that number.
    """
    by_period: dict[int, list] = {}
    for name, (metric, stat, period, cmp, thr, n) in rules.items():
        by_period.setdefault(period, []).append((name, metric, stat, cmp, thr, n))
    out = None
    for period, rs in by_period.items():
        own = series.where(F.col("metric").isin(sorted({m for _, m, *_ in rs})))
        entries = F.array(*[
            F.struct(F.lit(name).alias("rule"), F.col(stat).cast("double").alias("stat_value"),
                     ((F.col("metric") == metric) & _CMP[cmp](F.col(stat), F.lit(thr))).alias("breach"),
                     F.lit(n).alias("periods"))
            for name, metric, stat, cmp, thr, n in rs])
        breaching = (bucket_stats(own, period).select("metric", "bucket_start", F.inline(entries))
                     .where(F.col("breach"))
                     .withColumn("bucket_no", F.floor(F.unix_seconds(F.col("bucket_start").cast("timestamp"))
                                                      / period).cast("long")))
        counts = breaching.select("rule", "metric", "periods", "bucket_no", F.explode(F.sequence(
            F.lit(0), F.col("periods") - 1)).alias("ahead"), "bucket_start", "stat_value")
        itself = F.col("ahead") == 0
        alarms = (counts.groupBy("rule", "metric", "periods", (F.col("bucket_no") + F.col("ahead")).alias("bucket_no"))
                  .agg(F.count(F.lit(1)).alias("n"), F.max(F.when(itself, F.col("bucket_start"))).alias("bucket_start"),
                       F.max(F.when(itself, F.col("stat_value"))).alias("stat_value"))
                  .where((F.col("n") == F.col("periods")) & F.col("bucket_start").isNotNull())
                  .select("rule", "metric", "bucket_start", "stat_value"))
        out = alarms if out is None else out.unionByName(alarms)
    return out


def log_lines(txn: DataFrame) -> DataFrame:
    """Job log lines: one ERROR line per error transaction, tagged with its day's run id."""
    return txn.where(F.col("tipo_transacao") == "error").select(
        F.col("data_completa_transacao").alias("ts"),
        F.concat(F.lit("jr_"), *PARTITION_COLS).alias("run_id"),
        F.concat(F.lit("ERROR transaction "), F.col("codigo_lancamento"), F.lit(" account "),
                 F.col("numero_unico_conta")).alias("message"))


def log_scan(logs: DataFrame, contains: str | None = None, since: str | None = None,
             n: int | None = 10, run_id: str | None = None) -> DataFrame:
    """Filter by text, run and start time; last ``n`` lines, newest first."""
    out = logs
    if contains:
        out = out.where(F.col("message").contains(contains))
    if run_id:
        out = out.where(F.col("run_id") == run_id)
    if since:
        out = out.where(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    if n is not None:
        out = out.orderBy(F.col("ts").desc(), F.col("message").desc()).limit(n)
    return out


LEDGER = ("job string, run_id string, run_date string, state string, started_on timestamp_ntz, completed_on timestamp_ntz, "
          "execution_seconds double, rows_read long, rows_written long, rows_matched long, rows_quarantined long")


def record_runs(spark: SparkSession, ledger_path: str, reports: list[dict], job: str = "transaction-enrichment") -> None:
    """O1: append ``run_day`` or ``run_days`` reports to the run ledger (parquet, append-only)."""
    naive_utc = lambda t: None if t is None else t.astimezone(dt.timezone.utc).replace(tzinfo=None)
    rows = [(job, f"jr_{r['year']}{r['month']}{r['day']}", f"{r['year']}-{r['month']}-{r['day']}", r["status"],
             naive_utc(r.get("started_on")), naive_utc(r.get("completed_on")), float(r.get("seconds", 0.0)),
             *(int(r.get(c, 0)) for c in ("rows_read", "rows_written", "rows_matched", "rows_quarantined"))) for r in reports]
    spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("append").parquet(ledger_path)


def record_run(spark: SparkSession, ledger_path: str, report: dict, job: str = "transaction-enrichment") -> None:
    """O1: append one report."""
    record_runs(spark, ledger_path, [report], job)


def latest_run(runs: DataFrame, key: str = "job") -> DataFrame:
    """The latest attempt per job (partial max, skew-safe)."""
    return latest_per_key(runs, key, ["started_on", "run_id"])


def recent_runs(runs: DataFrame, n: int = 5) -> DataFrame:
    """L4: the last ``n`` runs."""
    return runs.orderBy(F.col("started_on").desc(), F.col("run_id").desc()).limit(n)


def run_cost(runs: DataFrame, price_per_dpu_hour: float = PRICE_PER_DPU_HOUR, dpu: int = DPU_PER_RUN) -> DataFrame:
    """DPU-hours and cost per job and month of recorded runs."""
    seconds = F.sum("execution_seconds")
    return (runs.groupBy("job", F.substring("run_date", 1, 7).alias("month"))
            .agg(F.count(F.lit(1)).alias("n_runs"), seconds.alias("total_seconds"),
                 (seconds * F.lit(float(dpu)) / F.lit(3600.0)).alias("dpu_hours"))
            .withColumn("cost_usd", F.col("dpu_hours") * F.lit(float(price_per_dpu_hour))))
