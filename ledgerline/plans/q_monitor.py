"""Step 6: monitoring."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import monitor as M
from ledgerline.operators.upsert import partition_folders
from ledgerline.plans import roles
from ledgerline.plans.job import run_days
from ledgerline.plans.registry import money_avg_sql, money_sum_sql, register, with_base
from ledgerline.schemas import ALARM_RULES
from ledgerline.session import path_exists, scratch_path
from ledgerline.streaming import alarms as A


def series(spark, sf_dir):
    return M.metric_series(roles.transactions(spark, sf_dir, with_partitions=False))


@register("metric_stats", with_base(f"""
SELECT tipo_transacao AS metric, time_bucket(INTERVAL '300 seconds', data_completa_transacao) AS bucket_start,
       COUNT(*) AS n_points, {money_sum_sql('valor_total_transacao')} AS sum_value,
       MIN(valor_total_transacao) AS min_value, MAX(valor_total_transacao) AS max_value,
       {money_avg_sql('valor_total_transacao')} AS avg_value
FROM tx GROUP BY ALL"""))
def metric_stats(spark, sf_dir):
    """Sum / min / max / average per type and 300-second period."""
    return M.metric_stats(series(spark, sf_dir), 300)


_STAT_SQL = {"sum": money_sum_sql("value"), "avg": money_avg_sql("value"), "min": "MIN(value)", "max": "MAX(value)"}


METRIC_SQL = "CASE event_id % 7 " + " ".join(f"WHEN {i} THEN '{r[0]}'" for i, r in enumerate(ALARM_RULES.values())) + " END"
POINTS_SQL = f"""points AS (SELECT {METRIC_SQL} AS metric, ts,
  CASE WHEN {METRIC_SQL} = 'ClusterStatus.red' THEN 0.0 ELSE value END AS value FROM events)"""


def alarm_sql(rule: str) -> str:
    metric, stat, period, cmp, thr, n = ALARM_RULES[rule]
    return f"""
SELECT '{rule}' AS rule, metric, bucket_start, stat_value FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY metric ORDER BY bucket_no
                           RANGE BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS run
  FROM (SELECT *, CAST(floor(epoch(bucket_start) / {period}) AS BIGINT) AS bucket_no FROM (
          SELECT metric, time_bucket(INTERVAL '{period} seconds', ts) AS bucket_start,
                 {_STAT_SQL[stat]} AS stat_value
          FROM points WHERE metric = '{metric}' GROUP BY ALL) WHERE stat_value {cmp} {thr}))
WHERE run >= {n}"""


def _alarm(rule):
    def build(spark, sf_dir):
        return M.evaluate_alarm(roles.metric_series(spark, sf_dir), rule, *ALARM_RULES[rule])
    return build


for _name, _rule in {"alarm_sum_2of2": "read_throttle", "alarm_avg_3of3": "cpu",
                     "alarm_min": "free_space", "alarm_max": "status_red"}.items():
    register(_name, with_base(alarm_sql(_rule), POINTS_SQL))(_alarm(_rule))


@register("alarm_rules", with_base("\nUNION ALL\n".join(f"SELECT * FROM ({alarm_sql(r)})" for r in ALARM_RULES), POINTS_SQL))
def alarm_rules(spark, sf_dir):
    """All seven alarm rules at once, each on its own metric."""
    return M.evaluate_rules(roles.metric_series(spark, sf_dir))


def transition_sql(rule: str) -> str:
    """First bucket of every run of alarmed buckets, and the bucket after its last."""
    period = ALARM_RULES[rule][2]
    return f"""
SELECT rule, metric, state, to_timestamp(no * {period})::TIMESTAMP AS bucket_start FROM (
  SELECT rule, metric, unnest(['ALARM', 'OK']) AS state, unnest([min(no), max(no) + 1]) AS no FROM (
    SELECT *, no - row_number() OVER (ORDER BY no) AS island FROM (
      SELECT rule, metric, CAST(floor(epoch(bucket_start) / {period}) AS BIGINT) AS no FROM ({alarm_sql(rule)}))) GROUP BY rule, metric, island)"""


@register("stream_alarms", with_base("\nUNION ALL\n".join(f"SELECT * FROM ({transition_sql(r)})" for r in ALARM_RULES), POINTS_SQL))
def stream_alarms(spark, sf_dir):
    """Transitions of the seven rules over the month's points, arriving in order in several micro-batches."""
    points, base = roles.metric_series(spark, sf_dir), scratch_path(spark, "points")
    schema = "metric string, ts timestamp_ntz, value double"
    own = points.where(F.col("metric").isin(sorted({m for m, *_ in ALARM_RULES.values()}))).select("metric", "ts", "value")
    for first, last in (("00", "09"), ("10", "19"), ("20", "31")):
        own.where(F.date_format("ts", "dd").between(first, last)).write.mode("append").parquet(base)
    end = own.agg(F.max("ts") + F.expr("INTERVAL 1 DAY")).first()[0]
    for minutes in (0, 10):  # points of no rule that move the watermark behind the last period
        spark.createDataFrame([("clock", end + dt.timedelta(minutes=minutes), 0.0)], schema).coalesce(1).write.mode("append").parquet(base)
    out = scratch_path(spark, "transitions")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 8).parquet(base)
    A.stream_alarms(spark, stream, out, scratch_path(spark, "ckpt"))
    return A.transitions(spark, out).select("rule", "metric", "state", F.col("bucket_start").cast("timestamp_ntz").alias("bucket_start"))


LOG_SQL = """logs AS (
  SELECT data_completa_transacao AS ts, 'jr_' || year || month || day AS run_id,
         'ERROR transaction ' || codigo_lancamento || ' account ' || numero_unico_conta AS message
  FROM tx WHERE tipo_transacao = 'error')"""


@register("log_scan", with_base("""
SELECT * FROM logs WHERE contains(message, 'account 42') AND ts >= TIMESTAMP '2024-01-10 00:00:00'
ORDER BY ts DESC, message DESC LIMIT 10""", LOG_SQL))
def log_scan(spark, sf_dir):
    """Last ten error lines about account 42 since 2024-01-10."""
    logs = M.log_lines(roles.transactions(spark, sf_dir))
    return M.log_scan(logs, contains="account 42", since="2024-01-10 00:00:00", n=10)


#: A day without files, run after all others.
EMPTY_DAY = ("2024", "03", "01")
RUNS_SQL = """runs AS (
  SELECT 'transaction-enrichment' AS job, 'jr_' || year || month || day AS run_id, year || '-' || month || '-' || day AS run_date,
         'succeeded' AS state, COUNT(*) AS rows_read, COUNT("nomeTitularConta") AS rows_matched FROM enr GROUP BY year, month, day
  UNION ALL SELECT 'transaction-enrichment', 'jr_20240301', '2024-03-01', 'empty', 0, 0)"""
_LEDGERS: dict = {}


def runs(spark, sf_dir):
    """The ledger of the job's runs for every day of the landed tree and a day without files (built once per
    application and table folder)."""
    at = (spark.sparkContext.applicationId, roles.version(spark, sf_dir))
    if at not in _LEDGERS or not path_exists(spark, _LEDGERS[at]):
        base, target, ledger = roles.landed_tree(spark, sf_dir), scratch_path(spark, "docs-runs"), scratch_path(spark, "ledger")
        days = [tuple(part.split("=", 1)[1] for part in p.split("/")) for p in partition_folders(spark, base)]
        M.record_runs(spark, ledger, run_days(spark, base, [*days, EMPTY_DAY], roles.customers(spark, sf_dir), target))
        _LEDGERS[at] = ledger
    return spark.read.schema(M.LEDGER).parquet(_LEDGERS[at])


@register("run_ledger", with_base("""
SELECT job, run_id, run_date, state, rows_read, rows_read AS rows_written, rows_matched, CAST(0 AS BIGINT) AS rows_quarantined,
       true AS timed FROM runs""", RUNS_SQL))
def run_ledger(spark, sf_dir):
    """A record per day of the tree; times differ from run to run and are only checked for order."""
    r = runs(spark, sf_dir)
    return r.select("job", "run_id", "run_date", "state", "rows_read", "rows_written", "rows_matched", "rows_quarantined",
                    (F.col("completed_on") >= F.col("started_on")).alias("timed"))


@register("latest_run", with_base("SELECT job, run_id, state, rows_read FROM runs ORDER BY run_id DESC LIMIT 1", RUNS_SQL))
def latest_run(spark, sf_dir):
    """The last run of the job and its state."""
    return M.latest_run(runs(spark, sf_dir)).select("job", "run_id", "state", "rows_read")


@register("recent_runs", with_base("SELECT run_id, state, rows_read FROM runs ORDER BY run_id DESC LIMIT 5", RUNS_SQL))
def recent_runs(spark, sf_dir):
    """The last five runs."""
    return M.recent_runs(runs(spark, sf_dir), 5).select("run_id", "state", "rows_read")


@register("run_cost", with_base("""
SELECT job, substr(run_date, 1, 7) AS month, COUNT(*) AS n_runs, true AS priced FROM runs GROUP BY ALL""", RUNS_SQL))
def run_cost(spark, sf_dir):
    """Runs per month and whether their price is 2 DPU at 0.44 per hour for the recorded seconds."""
    cost = M.run_cost(runs(spark, sf_dir))
    priced = F.abs(F.col("cost_usd") - F.col("total_seconds") * 2 / 3600 * 0.44) < 1e-9
    return cost.select("job", "month", "n_runs", priced.alias("priced"))
