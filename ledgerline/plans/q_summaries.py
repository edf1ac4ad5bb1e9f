"""Questions answered from stored summaries: sketches (A9, U2), digests (R1), the rollup."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import summaries as S
from ledgerline.plans import roles
from ledgerline.plans.q_sinks import DOC_ORDER, docs_with_partitions, _indexed_until_28
from ledgerline.plans.registry import money_sum_sql, register, with_base
from ledgerline.session import scratch_path


@register("distinct_accounts_range", with_base("""
SELECT s.day AS start_day, CAST(count(DISTINCT numero_unico_conta) AS BIGINT) AS distinct_accounts, true AS within_3_percent
FROM (SELECT DISTINCT year, month, day FROM tx) s JOIN tx t
  ON t.year || t.month || t.day BETWEEN s.year || s.month || s.day AND '20240131' GROUP BY s.year, s.month, s.day"""))
def distinct_accounts_range(spark, sf_dir):
    """Distinct accounts from each day to the month's end: the estimate of the days' sketches against the exact number."""
    tx, path = roles.transactions(spark, sf_dir), scratch_path(spark, "sketches")
    S.store_sketches(tx, path)
    day = F.to_date(F.concat_ws("-", "year", "month", "day"))
    ranges = tx.select(day.alias("start")).distinct().withColumn("stop", F.lit("2024-01-31").cast("date"))
    guess = S.distinct_over(spark, path, ranges)
    # an account counts in every range that begins no later than its last day
    last = tx.where("numero_unico_conta IS NOT NULL").groupBy("numero_unico_conta").agg(F.max(day).alias("last"))
    starts = last.select(F.explode(F.sequence(F.lit("2024-01-01").cast("date"), "last")).alias("start"))
    exact = guess.join(starts.groupBy("start").agg(F.count(F.lit(1)).alias("distinct_accounts")), "start")
    return exact.select(F.date_format("start", "dd").alias("start_day"), "distinct_accounts",
                        (F.abs(F.col("distinct_keys") - F.col("distinct_accounts")) <= 0.03 * F.col("distinct_accounts")).alias("within_3_percent"))


@register("reconcile_digest_tree", with_base("""
SELECT 3 AS level, year, month, day, CAST(1 AS BIGINT) AS differing_below, COUNT(*) AS source_rows, CAST(0 AS BIGINT) AS target_rows
FROM tx WHERE day > '28' GROUP BY year, month, day
UNION ALL SELECT 2, year, month, NULL, COUNT(DISTINCT day) FILTER (day > '28'), COUNT(*), COUNT(*) FILTER (day <= '28') FROM tx GROUP BY year, month HAVING COUNT(*) FILTER (day > '28') > 0
UNION ALL SELECT 1, year, NULL, NULL, COUNT(DISTINCT month || day) FILTER (day > '28'), COUNT(*), COUNT(*) FILTER (day <= '28') FROM tx GROUP BY year HAVING COUNT(*) FILTER (day > '28') > 0
UNION ALL SELECT 0, NULL, NULL, NULL, COUNT(DISTINCT year || month || day) FILTER (day > '28'), COUNT(*), COUNT(*) FILTER (day <= '28') FROM tx HAVING COUNT(*) FILTER (day > '28') > 0"""))
def reconcile_digest_tree(spark, sf_dir):
    """Where the landed tree and a target that lacks the days after the 28th differ, from the root down."""
    source, target = _indexed_until_28(spark, sf_dir)
    return S.differing(S.digests(source, "codigo_lancamento"), S.digests(target, "codigoLancamento"))


@register("rollup_after_upserts", with_base(f"""
SELECT year, month, day, "tipoTransacao", "tipoProdutoTransacao", COUNT(*) AS n, {money_sum_sql("amount")} AS sum_valor
FROM (SELECT *, CASE WHEN "dataCompletaTransacao" >= TIMESTAMP '2024-01-15 00:00:00' THEN "valorTotalTransacao" + 1
                     ELSE "valorTotalTransacao" END AS amount FROM enr) GROUP BY ALL"""))
def rollup_after_upserts(spark, sf_dir):
    """Counts and exact sums kept through three upserts (days 1-20, then days 15-30 twice with new amounts):
    replaced rows are retracted."""
    target, rollup = scratch_path(spark, "docs-rolled"), scratch_path(spark, "rollup")
    S.upsert_with_rollup(spark, target, rollup, docs_with_partitions(spark, sf_dir, end="2024-01-21 00:00:00"), order_by=DOC_ORDER)
    batch = docs_with_partitions(spark, sf_dir, start="2024-01-15 00:00:00").withColumn("valorTotalTransacao", F.col("valorTotalTransacao") + 1)
    for _ in range(2):
        S.upsert_with_rollup(spark, target, rollup, batch, order_by=DOC_ORDER)
    return S.rolled_up(spark, target, rollup).withColumn("sum_valor", F.col("cents").cast("double")).drop("cents")


@register("rollup_terms", with_base("""
SELECT "tipoTransacao" AS key, COUNT(*) AS doc_count FROM enr WHERE "tipoTransacao" IS NOT NULL GROUP BY ALL ORDER BY doc_count DESC, key LIMIT 10"""))
def rollup_terms(spark, sf_dir):
    """Documents per type from the rollup, after one half was loaded twice."""
    target, rollup = scratch_path(spark, "docs-rolled"), scratch_path(spark, "rollup")
    S.upsert_with_rollup(spark, target, rollup, docs_with_partitions(spark, sf_dir), order_by=DOC_ORDER)
    S.upsert_with_rollup(spark, target, rollup, docs_with_partitions(spark, sf_dir, end="2024-01-16 00:00:00"), order_by=DOC_ORDER)
    return S.terms_of(S.rolled_up(spark, target, rollup), "tipoTransacao")
