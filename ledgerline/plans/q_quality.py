"""Step 5: lookup planning and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import enrich as E
from ledgerline.operators import quality as Q
from ledgerline.operators.sinks import write_partitioned_jsonl
from ledgerline.plans import roles
from ledgerline.plans.registry import register, with_base
from ledgerline.schemas import ENR, PRODUCT_TYPES, TRANSACTION_TYPES
from ledgerline.session import scratch_path
from ledgerline.sources.customers import load_customers
from ledgerline.sources.json_files import scan_tree


@register("distinct_accounts_per_day", with_base(
    "SELECT year, month, day, COUNT(DISTINCT numero_unico_conta) AS distinct_accounts FROM tx GROUP BY ALL"))
def distinct_accounts_per_day(spark, sf_dir):
    return E.distinct_accounts(roles.transactions(spark, sf_dir))


@register("lookup_plan", with_base("""
SELECT year, month, day, COUNT(DISTINCT numero_unico_conta) AS distinct_accounts,
       CAST(ceil(COUNT(DISTINCT numero_unico_conta) / 100.0) AS BIGINT) AS lookup_requests
FROM tx GROUP BY ALL"""))
def lookup_plan(spark, sf_dir):
    """Batched key lookups a day would need (100 keys per request)."""
    return E.lookup_plan(roles.transactions(spark, sf_dir))


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


@register("domain_violations", with_base(f"""
SELECT 'tipoTransacao' AS column_name, "tipoTransacao" AS value, COUNT(*) AS n_rows FROM enr
WHERE "tipoTransacao" IS NULL OR "tipoTransacao" NOT IN ({_in(TRANSACTION_TYPES)}) GROUP BY ALL
UNION ALL
SELECT 'tipoProdutoTransacao', "tipoProdutoTransacao", COUNT(*) FROM enr
WHERE "tipoProdutoTransacao" IS NULL OR "tipoProdutoTransacao" NOT IN ({_in(PRODUCT_TYPES)}) GROUP BY ALL"""))
def domain_violations(spark, sf_dir):
    """Type and product values outside their domains."""
    docs = roles.stored_documents(spark, sf_dir)
    return Q.check_domains(docs, {"tipoTransacao": TRANSACTION_TYPES, "tipoProdutoTransacao": PRODUCT_TYPES})


@register("dq_volume", with_base("""
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT numero_unico_conta) AS n_accounts, 1000 AS min_rows,
       20 AS min_accounts, COUNT(*) >= 1000 AND COUNT(DISTINCT numero_unico_conta) >= 20 AS ok FROM tx"""))
def dq_volume(spark, sf_dir):
    return Q.check_volume(roles.transactions(spark, sf_dir, with_partitions=False))


@register("dq_partition_layout", with_base("""
SELECT year, month, CASE WHEN CAST(codigo_lancamento AS BIGINT) % 97 = 0 THEN '31' ELSE day END AS day,
       COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE CAST(codigo_lancamento AS BIGINT) % 97 = 0 AND day <> '31') AS n_mismatch
FROM tx GROUP BY ALL"""))
def dq_partition_layout(spark, sf_dir):
    """Rows whose directory is not their event date: every 97th id was landed under day 31."""
    tx = roles.transactions(spark, sf_dir)
    moved = F.when(F.col("codigo_lancamento").cast("long") % 97 == 0, F.lit("31")).otherwise(F.col("day"))
    base = write_partitioned_jsonl(tx.withColumn("day", moved), scratch_path(spark, "txn-misplaced"))
    return Q.check_layout(scan_tree(spark, base))


def _schema_sql() -> str:
    parts = []
    for f in ENR.fields:
        t = f.dataType.simpleString()
        actual = {"zipCode": "", "valorTotalTransacao": "string"}.get(f.name, t)
        count = "COUNT(NULL)" if actual == "" else f'COUNT("{f.name}")'
        parts.append(f"SELECT '{f.name}' AS column_name, '{t}' AS expected_type, '{actual}' AS actual_type, "
                     f"{str(actual == t).lower()} AS ok, {count} AS n_non_null FROM enr")
    parts.append("SELECT 'canal', '', 'string', false, COUNT(*) FILTER (WHERE \"tipoTransacao\" = 'error') FROM enr")
    return with_base("\nUNION ALL\n".join(parts))


@register("dq_schema", _schema_sql())
def dq_schema(spark, sf_dir):
    """Nine fields are expected; these documents lack one, hold one as text and carry one too many."""
    docs = roles.stored_documents(spark, sf_dir).drop("zipCode").withColumn(
        "valorTotalTransacao", F.col("valorTotalTransacao").cast("string")).withColumn(
        "canal", F.when(F.col("tipoTransacao") == "error", F.lit("app")))
    return Q.check_schema(docs, ENR)


@register("dq_nulls_and_keys", with_base(
    'SELECT COUNT(*) AS n_rows, COUNT(DISTINCT "codigoLancamento") AS n_distinct_ids, '
    + ", ".join(f'COUNT(*) FILTER (WHERE "{f.name}" IS NULL) AS "nulls_{f.name}"' for f in ENR.fields)
    + " FROM enr"))
def dq_nulls_and_keys(spark, sf_dir):
    """Key uniqueness and per-column null counts."""
    return Q.profile(roles.stored_documents(spark, sf_dir))


@register("dq_report", with_base(f"""
SELECT 'volume_rows' AS check_name, CAST(COUNT(*) AS DOUBLE) AS value, 1000.0::DOUBLE AS threshold,
       CASE WHEN COUNT(*) >= 1000 THEN 'pass' ELSE 'fail' END AS status FROM enr
UNION ALL SELECT 'distinct_accounts', CAST(COUNT(DISTINCT "numeroUnicoConta") AS DOUBLE), 20.0::DOUBLE,
                 CASE WHEN COUNT(DISTINCT "numeroUnicoConta") >= 20 THEN 'pass' ELSE 'fail' END FROM enr
UNION ALL SELECT 'duplicate_ids', CAST(COUNT(*) - COUNT(DISTINCT "codigoLancamento") AS DOUBLE), 0.0::DOUBLE,
                 CASE WHEN COUNT(*) - COUNT(DISTINCT "codigoLancamento") = 0 THEN 'pass' ELSE 'fail' END FROM enr
UNION ALL SELECT 'null_ids', CAST(COUNT(*) FILTER (WHERE "codigoLancamento" IS NULL) AS DOUBLE), 0.0::DOUBLE,
                 CASE WHEN COUNT(*) FILTER (WHERE "codigoLancamento" IS NULL) = 0 THEN 'pass' ELSE 'fail' END FROM enr
UNION ALL SELECT 'tipo_out_of_domain', CAST(COUNT(*) FILTER (WHERE "tipoTransacao" IS NULL OR
                 "tipoTransacao" NOT IN ({_in(TRANSACTION_TYPES)})) AS DOUBLE), 0.0::DOUBLE,
                 CASE WHEN COUNT(*) FILTER (WHERE "tipoTransacao" IS NULL OR "tipoTransacao" NOT IN ({_in(TRANSACTION_TYPES)})) = 0
                      THEN 'pass' ELSE 'fail' END FROM enr
UNION ALL SELECT 'produto_out_of_domain', CAST(COUNT(*) FILTER (WHERE "tipoProdutoTransacao" IS NULL OR
                 "tipoProdutoTransacao" NOT IN ({_in(PRODUCT_TYPES)})) AS DOUBLE), 0.0::DOUBLE,
                 CASE WHEN COUNT(*) FILTER (WHERE "tipoProdutoTransacao" IS NULL OR "tipoProdutoTransacao" NOT IN ({_in(PRODUCT_TYPES)})) = 0
                      THEN 'pass' ELSE 'fail' END FROM enr
UNION ALL SELECT 'unmatched_documents', CAST(COUNT(*) FILTER (WHERE "nomeTitularConta" IS NULL) AS DOUBLE),
                 CAST(NULL AS DOUBLE), 'info' FROM enr
UNION ALL SELECT 'customers_rejected', CAST((SELECT COUNT(*) FROM cust_items) - (SELECT COUNT(*) FROM cust) AS DOUBLE),
                 CAST(NULL AS DOUBLE), 'info'"""))
def dq_report(spark, sf_dir):
    """All checks in one table."""
    _, rejected = load_customers(roles.customer_items(spark, sf_dir))
    return Q.dq_report(roles.stored_documents(spark, sf_dir), rejected)
