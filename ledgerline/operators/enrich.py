"""Dimension enrichment and the lookup family.

The enrichment is a declarative left outer equi-join: Catalyst broadcasts the
customer side while its estimated size is under
``spark.sql.autoBroadcastJoinThreshold`` (a checked bound) and otherwise
plans a sort-merge join whose hot account keys AQE splits
(``spark.sql.adaptive.skewJoin.enabled``).  No user code hashes or batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import pct_rounded
from ledgerline.schemas import CUST_KEY, LOOKUP_BATCH_KEYS, PARTITION_COLS

DIM_COLS = ("nome_titular_conta", "data_nascimento_titular_conta", "zip_code")


def enrich(txn: DataFrame, customers: DataFrame, key: str = CUST_KEY,
           dedupe_dim_by: str | None = None, salt_buckets: int | None = None,
           salt_by: str = "codigo_lancamento") -> DataFrame:
    """Every transaction kept, customer fields null when unmatched.

    ``customers`` must be unique on ``key`` (the keyed upsert guarantees it);
    for a dimension that may repeat a key, ``dedupe_dim_by`` names the column
    whose greatest value wins (skew-safe partial aggregate) so no transaction
    is duplicated.  A null account never matches (D11): only that row stays
    unenriched.

    ``salt_buckets`` is for plans without adaptive skew handling (streaming
    queries run without AQE) when the dimension is too large to broadcast:
    each transaction gets a deterministic salt in [0, n) from the hash of
    ``salt_by`` and the dimension is replicated once per salt, so a hot
    account's rows spread over n join tasks.  The result is unchanged.
    """
    dim = customers
    if dedupe_dim_by is not None:
        from ledgerline.operators.sinks import latest_per_key
        dim = latest_per_key(dim.select(key, *DIM_COLS, dedupe_dim_by), key, [dedupe_dim_by])
    dim = dim.select(key, *DIM_COLS)
    if not salt_buckets:
        return txn.join(dim, on=key, how="left")
    salted = txn.withColumn("_salt", F.pmod(F.xxhash64(F.col(salt_by)), F.lit(salt_buckets)).cast("int"))
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    return salted.join(copies, on=[key, "_salt"], how="left").drop("_salt")


def lookup(customers: DataFrame, txn: DataFrame, key: str = CUST_KEY) -> DataFrame:
    """Dimension rows whose key occurs in the facts (semi join, no duplicates).

    The fact keys are de-duplicated first (partial aggregate in every task), so
    an account that owns a large share of the transactions ships one row per
    task, not all its rows, into the join.
    """
    keys = txn.select(key).where(F.col(key).isNotNull()).distinct()
    return customers.join(keys, on=key, how="left_semi")


def unmatched(txn: DataFrame, customers: DataFrame, key: str = CUST_KEY) -> DataFrame:
    """Transactions with no customer (anti join; null accounts included)."""
    return txn.join(customers.select(key), on=key, how="left_anti")


def referential_check(txn: DataFrame, customer_keys: DataFrame, key: str = CUST_KEY) -> DataFrame:
    """Every account must exist in the customer table; one scan of the facts."""
    keys = customer_keys.select(key).where(F.col(key).isNotNull()).distinct() \
        .withColumn("_known", F.lit(True))
    flagged = txn.select(key).join(keys, on=key, how="left")
    orphan = F.col("_known").isNull()
    return flagged.agg(
        F.count(F.lit(1)).alias("n_transactions"),
        F.count_if(orphan).alias("n_orphan_rows"),
        F.count_distinct(F.when(orphan, F.col(key))).alias("n_orphan_accounts"),
    ).withColumn("ok", F.col("n_orphan_rows") == 0)


def enrichment_report(source: DataFrame, enriched: DataFrame, by=PARTITION_COLS,
                      matched_col: str = "nome_titular_conta") -> DataFrame:
    """A11 per group: rows read (counted in the input), rows enriched and matched (counted in the
    output) and both rates (D3).

    ``throughput_rate`` is enriched / read: 100 unless the join lost or doubled rows; ``match_rate``
    counts rows whose customer was found.  Both sides are aggregated before they meet.
    """
    keys = list(by)
    read = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_read"))
    out = enriched.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_enriched"), F.count(matched_col).alias("rows_matched"))
    none = [F.lit(None).cast("long").alias(c) for c in ("rows_read", "rows_enriched", "rows_matched")]
    both = read.select(*keys, "rows_read", none[1], none[2]).unionByName(out.select(*keys, none[0], "rows_enriched", "rows_matched"))
    counted = both.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
                                        for c in ("rows_read", "rows_enriched", "rows_matched")])
    return counted.select(
        *keys, "rows_read", "rows_enriched", "rows_matched",
        pct_rounded("rows_enriched", "rows_read", 2).alias("throughput_rate"),
        pct_rounded("rows_matched", "rows_read", 2).alias("match_rate"),
        F.format_string("%.2f%%", pct_rounded("rows_matched", "rows_read", 2)).alias("match_rate_text"))


def distinct_accounts(txn: DataFrame, by=PARTITION_COLS, key: str = CUST_KEY,
                      approx_rsd: float | None = None) -> DataFrame:
    """Number of distinct accounts per group (nulls are not accounts).

    Exact by default (a shuffle of the distinct (group, key) pairs); with
    ``approx_rsd`` a HyperLogLog++ sketch per task is merged instead, which
    ships a few KB per task regardless of how many accounts there are.
    """
    agg = (F.count_distinct(key) if approx_rsd is None
           else F.approx_count_distinct(key, approx_rsd))
    return txn.groupBy(*by).agg(agg.alias("distinct_accounts"))


def lookup_plan(txn: DataFrame, by=PARTITION_COLS, batch: int = LOOKUP_BATCH_KEYS,
                key: str = CUST_KEY, approx_rsd: float | None = None) -> DataFrame:
    """A10: requests needed per group = ceil(distinct keys / batch)."""
    d = distinct_accounts(txn, by, key, approx_rsd)
    return d.select(*by, "distinct_accounts",
                    F.ceil(F.col("distinct_accounts") / F.lit(batch)).cast("long").alias("lookup_requests"))
