"""Step 1: enrichment core."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import enrich as E
from ledgerline.operators.documents import to_document
from ledgerline.plans import roles
from ledgerline.plans.registry import ENR_COLS_SQL, TX_COLS_SQL, pct_sql, register, with_base
from ledgerline.schemas import TXN_COLS

DAY = ("2024", "01", "15")
DAY_START, DAY_END = "2024-01-15 00:00:00", "2024-01-16 00:00:00"


def enriched(spark, sf_dir, start=None, end=None, keep=()):
    tx = roles.transactions(spark, sf_dir, start, end)
    return to_document(E.enrich(tx, roles.customers(spark, sf_dir)), keep=keep)


@register("enrich_left_join", with_base(
    f"SELECT {ENR_COLS_SQL} FROM enr WHERE year = '2024' AND month = '01' AND day = '15'"))
def enrich_left_join(spark, sf_dir):
    """Enriched transactions of 2024-01-15 (the daily job's question)."""
    return enriched(spark, sf_dir, DAY_START, DAY_END)


@register("enriched_documents", with_base(f"SELECT {ENR_COLS_SQL} FROM enr"))
def enriched_documents(spark, sf_dir):
    """All transactions as nine-field camelCase documents."""
    return enriched(spark, sf_dir)


@register("keyed_lookup", with_base(
    "SELECT * FROM cust WHERE numero_unico_conta IN (SELECT numero_unico_conta FROM tx)"))
def keyed_lookup(spark, sf_dir):
    """Customer rows whose account occurs in the transactions (semi join)."""
    return E.lookup(roles.customers(spark, sf_dir), roles.transactions(spark, sf_dir))


@register("unmatched_anti_join", with_base(
    f"SELECT {TX_COLS_SQL} FROM tx WHERE NOT EXISTS "
    "(SELECT 1 FROM cust c WHERE c.numero_unico_conta = tx.numero_unico_conta)"))
def unmatched_anti_join(spark, sf_dir):
    """Transactions without a valid customer."""
    tx = roles.transactions(spark, sf_dir, with_partitions=False)
    return E.unmatched(tx, roles.customers(spark, sf_dir)).select(*TXN_COLS)


@register("enrichment_rate", with_base(f"""
SELECT year, month, day, rows_read, rows_enriched, rows_matched,
       {pct_sql('rows_enriched', 'rows_read', 2)} AS throughput_rate,
       {pct_sql('rows_matched', 'rows_read', 2)} AS match_rate,
       printf('%.2f%%', {pct_sql('rows_matched', 'rows_read', 2)}) AS match_rate_text
FROM (SELECT year, month, day, COUNT(*) AS rows_read FROM tx GROUP BY ALL)
JOIN (SELECT year, month, day, COUNT(*) AS rows_enriched, COUNT("nomeTitularConta") AS rows_matched
      FROM (SELECT t.year, t.month, t.day, c.nome_titular_conta AS "nomeTitularConta"
            FROM tx t LEFT JOIN (SELECT * FROM cust UNION ALL SELECT * FROM cust WHERE numero_unico_conta = '1') c
            ON t.numero_unico_conta = c.numero_unico_conta) GROUP BY ALL) USING (year, month, day)"""))
def enrichment_rate(spark, sf_dir):
    """Per day: read / enriched / matched counts and rates, against a dimension in which account 1
    stands twice, so that its days enrich more rows than they read."""
    tx, cust = roles.transactions(spark, sf_dir), roles.customers(spark, sf_dir)
    doubled = cust.unionByName(cust.where(F.col("numero_unico_conta") == "1"))
    return E.enrichment_report(tx, E.enrich(tx, doubled))


@register("referential_check", with_base("""
SELECT COUNT(*) AS n_transactions,
       COUNT(*) FILTER (WHERE k.numero_unico_conta IS NULL) AS n_orphan_rows,
       COUNT(DISTINCT t.numero_unico_conta) FILTER (WHERE k.numero_unico_conta IS NULL) AS n_orphan_accounts,
       COUNT(*) FILTER (WHERE k.numero_unico_conta IS NULL) = 0 AS ok
FROM tx t LEFT JOIN (SELECT DISTINCT numero_unico_conta FROM cust_items) k
  ON t.numero_unico_conta = k.numero_unico_conta"""))
def referential_check(spark, sf_dir):
    """Every transaction account exists among all customer items."""
    return E.referential_check(roles.transactions(spark, sf_dir, with_partitions=False),
                               roles.customer_items(spark, sf_dir))


@register("unenriched_filter", with_base(
    f'SELECT {ENR_COLS_SQL} FROM enr WHERE "nomeTitularConta" IS NULL'))
def unenriched_filter(spark, sf_dir):
    """Documents whose customer was not found."""
    return enriched(spark, sf_dir).where(F.col("nomeTitularConta").isNull())
