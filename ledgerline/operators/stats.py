"""Producer statistics (A6-A8, L2): shares, totals, per-partition counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import money_avg, money_sum, partition_path, pct_rounded, pct_text
from ledgerline.schemas import PARTITION_COLS

def share(df: DataFrame, field: str) -> DataFrame:
    """Count and percent of total per value (1 decimal, half-up) plus ``%`` text.

    The total is a scalar subquery over the same counts (their shuffle is reused), so no task holds
    all groups however many values the field has."""
    counts = df.groupBy(field).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    pct = pct_rounded(F.col("n"), total, 1)
    return counts.select(field, "n", pct.alias("pct"), pct_text(pct).alias("pct_text"))


def totals(df: DataFrame, value: str = "valor_total_transacao") -> DataFrame:
    """Number of transactions, exact total value, average value."""
    return df.agg(F.count(F.lit(1)).alias("n_transactions"),
                  money_sum(value).alias("total_valor"),
                  money_avg(value).alias("avg_valor"))


def partition_counts(df: DataFrame, cols=PARTITION_COLS) -> DataFrame:
    """Rows per date partition in key order, with the partition path and count of partitions."""
    counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
    n_partitions = counts.agg(F.count(F.lit(1))).scalar()
    return (counts.select(*cols, partition_path(*cols).alias("partition_path"), "n_rows",
                          n_partitions.alias("n_partitions"))
            .orderBy(*cols))
