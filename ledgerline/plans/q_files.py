"""Step 3: files in.

Each query writes the transactions (or customer items) to a fresh folder in
the shared scratch area with the library's writers, then answers from the
files, so reader and writer are tested together.  JSON text carries second
precision, hence ``date_trunc('second', ...)`` in the oracles.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import epoch_millis, iso_millis, partition_name, partition_path
from ledgerline.operators import stats as ST
from ledgerline.operators.documents import camelize, enforce
from ledgerline.operators.sinks import read_table, txn_line, write_json_array, write_jsonl, write_partitioned_jsonl
from ledgerline.plans import roles
from ledgerline.plans.job import report_frame, run_day
from ledgerline.plans.q_core import enriched
from ledgerline.plans.registry import register, with_base
from ledgerline.schemas import CUST_RAW, DOCS_SCHEMA, PARTITION_COLS, TXN, TXN_RAW_WITH_CORRUPT
from ledgerline.session import scratch_path, touch
from ledgerline.sources import json_files as J
from ledgerline.sources.customers import parse_customers
from ledgerline.sources.inventory import file_inventory as file_inventory_of

TXR_SQL = """txr AS (
  SELECT codigo_lancamento, numero_unico_conta, valor_total_transacao,
         date_trunc('second', data_completa_transacao) AS data_completa_transacao,
         tipo_transacao, tipo_produto_transacao, year, month, day FROM tx)"""
TXR_COLS = ("codigo_lancamento, numero_unico_conta, valor_total_transacao, data_completa_transacao, "
            "tipo_transacao, tipo_produto_transacao, year, month, day")


def jsonl_tree(spark, sf_dir, fresh: bool = False) -> str:
    """The landed tree; ``fresh`` writes a private one (writer tests, or queries that add to it)."""
    if not fresh:
        return roles.landed_tree(spark, sf_dir)
    return write_partitioned_jsonl(roles.transactions(spark, sf_dir), scratch_path(spark, "txn-jsonl"))


@register("day_scan", with_base(f"SELECT {TXR_COLS} FROM txr WHERE year = '2024' AND month = '01' AND day = '15'", TXR_SQL))
def day_scan(spark, sf_dir):
    """One day read back from the tree (directory pruning, explicit schema)."""
    return J.scan_day(spark, jsonl_tree(spark, sf_dir), "2024", "01", "15")


@register("date_range_scan", with_base(
    f"SELECT {TXR_COLS} FROM txr WHERE year || '-' || month || '-' || day BETWEEN '2024-01-10' AND '2024-01-12'", TXR_SQL))
def date_range_scan(spark, sf_dir):
    """Days 10 to 12 inclusive."""
    return J.scan_range(spark, jsonl_tree(spark, sf_dir), "2024-01-10", "2024-01-12")


@register("tree_partition_counts", with_base("""
SELECT year, month, day, 'year=' || year || '/month=' || month || '/day=' || day AS partition_path,
       COUNT(*) AS n_rows, CAST(COUNT(*) OVER () AS BIGINT) AS n_partitions
FROM tx GROUP BY year, month, day ORDER BY year, month, day"""))
def tree_partition_counts(spark, sf_dir):
    """Rows per discovered partition, in key order."""
    return ST.partition_counts(J.scan_tree(spark, jsonl_tree(spark, sf_dir)))


@register("partitioned_write_roundtrip", with_base(f"SELECT {TXR_COLS} FROM txr", TXR_SQL))
def partitioned_write_roundtrip(spark, sf_dir):
    """Write the tree, read all of it back."""
    return J.scan_tree(spark, jsonl_tree(spark, sf_dir, fresh=True))


@register("json_array_scan", with_base("SELECT * FROM cust_items"))
def json_array_scan(spark, sf_dir):
    """Customer items saved as JSON array files, read with the multi-line reader."""
    path = write_json_array(roles.customer_items(spark, sf_dir), scratch_path(spark, "cust-array"))
    return J.scan_array(spark, path, CUST_RAW)


@register("schema_evolution_union", with_base("""
SELECT codigo_lancamento, numero_unico_conta, valor_total_transacao, data_completa_transacao,
       tipo_transacao, tipo_produto_transacao, CAST(NULL AS VARCHAR) AS canal
FROM tx WHERE data_completa_transacao < TIMESTAMP '2024-01-16 00:00:00'
UNION ALL
SELECT codigo_lancamento, numero_unico_conta, valor_total_transacao, data_completa_transacao,
       tipo_transacao, CAST(NULL AS VARCHAR), CASE WHEN tipo_produto_transacao = 'PIX' THEN 'mobile' ELSE 'web' END
FROM tx WHERE data_completa_transacao >= TIMESTAMP '2024-01-16 00:00:00'"""))
def schema_evolution_union(spark, sf_dir):
    """Old days without ``canal``; new days add ``canal`` and lose the product column."""
    old = roles.transactions(spark, sf_dir, end="2024-01-16 00:00:00", with_partitions=False)
    new = (roles.transactions(spark, sf_dir, start="2024-01-16 00:00:00", with_partitions=False)
           .withColumn("canal", F.when(F.col("tipo_produto_transacao") == "PIX", "mobile").otherwise("web"))
           .drop("tipo_produto_transacao"))
    return J.evolve_union(old, new)


@register("enforce_schema", with_base("""
SELECT codigo_lancamento, numero_unico_conta,
       CAST(CAST(floor(valor_total_transacao) AS INTEGER) AS DOUBLE) AS valor_total_transacao,
       data_completa_transacao, tipo_transacao, tipo_produto_transacao FROM tx"""))
def enforce_schema(spark, sf_dir):
    """Integer amounts widened to double, an extra column dropped."""
    src = (roles.transactions(spark, sf_dir)
           .withColumn("valor_total_transacao", F.floor("valor_total_transacao").cast("int")))
    return enforce(src, TXN)


@register("camelize_columns", with_base("""
SELECT numero_unico_conta AS "numeroUnicoConta", nome_titular_conta AS "nomeTitularConta",
       data_nascimento_titular_conta AS "dataNascimentoTitularConta", "zip-code" AS "zipCode",
       data_criacao_registro AS "dataCriacaoRegistro" FROM cust_items"""))
def camelize_columns(spark, sf_dir):
    return camelize(roles.customer_items(spark, sf_dir))


@register("customer_parse", with_base("""
SELECT numero_unico_conta, nome_titular_conta,
       try_strptime(data_nascimento_titular_conta, '%Y-%m-%dT%H:%M:%SZ') AS data_nascimento_titular_conta,
       "zip-code" AS zip_code,
       CASE WHEN reason IS NULL THEN 'valid' ELSE 'rejected' END AS status, reason
FROM (SELECT *, CASE WHEN numero_unico_conta IS NULL THEN 'missing:numero_unico_conta'
                     WHEN nome_titular_conta IS NULL THEN 'missing:nome_titular_conta'
                     WHEN data_nascimento_titular_conta IS NULL THEN 'missing:data_nascimento_titular_conta'
                     WHEN "zip-code" IS NULL THEN 'missing:zip-code'
                     WHEN data_criacao_registro IS NULL THEN 'missing:data_criacao_registro'
                     WHEN try_strptime(data_nascimento_titular_conta, '%Y-%m-%dT%H:%M:%SZ') IS NULL THEN 'birth_date'
                END AS reason FROM cust_items)"""))
def customer_parse(spark, sf_dir):
    """Strict customer parse: status and first failing rule per item."""
    return parse_customers(roles.customer_items(spark, sf_dir))


@register("quarantine_reasons", with_base("""
SELECT reason, COUNT(*) AS n_rows FROM (
  SELECT CASE WHEN CAST(codigo_lancamento AS BIGINT) % 97 = 0 THEN 'json'
              WHEN CAST(codigo_lancamento AS BIGINT) % 89 = 0 THEN 'timestamp'
              WHEN CAST(codigo_lancamento AS BIGINT) % 83 = 0 THEN 'amount'
              ELSE 'valid' END AS reason FROM tx)
GROUP BY reason"""))
def quarantine_reasons(spark, sf_dir):
    """Corrupt lines, bad timestamps and missing amounts injected by an id rule, then split off."""
    tx = roles.transactions(spark, sf_dir)
    n = F.col("codigo_lancamento").cast("long")
    line = (F.when(n % 97 == 0, F.lit('{"codigo'))
            .when(n % 89 == 0, txn_line(overrides={"data_completa_transacao": F.lit("garbage")}))
            .when(n % 83 == 0, txn_line(overrides={"valor_total_transacao": F.lit(None).cast("double")}))
            .otherwise(txn_line()))
    base = scratch_path(spark, "txn-dirty")
    write_jsonl(tx.select(line.alias("value"), "codigo_lancamento", *PARTITION_COLS), base,
                key="codigo_lancamento")
    raw = J.read_jsonl(spark, base, TXN_RAW_WITH_CORRUPT)
    return (raw.groupBy(F.coalesce(J.quarantine_reason(), F.lit("valid")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


@register("empty_day", with_base("""
SELECT '2024' AS year, '01' AS month, '15' AS day, 'succeeded' AS status, COUNT(*) AS rows_read,
       COUNT(*) AS rows_written, COUNT(*) AS rows_stored FROM tx WHERE year = '2024' AND month = '01' AND day = '15'
UNION ALL SELECT '2024', '03', '01', 'empty', 0, 0, COUNT(*)
FROM tx WHERE year = '2024' AND month = '01' AND day = '15'"""))
def empty_day(spark, sf_dir):
    """The daily job on a full day and on a day without files: the second leaves the target as it is."""
    base, target = jsonl_tree(spark, sf_dir, fresh=True), scratch_path(spark, "docs-target")
    out = None
    for month, day in (("01", "15"), ("03", "01")):
        report = report_frame(spark, run_day(spark, base, "2024", month, day, roles.customers(spark, sf_dir), target))
        stored = read_table(spark, target, DOCS_SCHEMA).count()
        report = report.select("year", "month", "day", "status", "rows_read", "rows_written", F.lit(stored).cast("long").alias("rows_stored"))
        out = report if out is None else out.unionByName(report)
    return out


@register("table_sample", with_base("SELECT * FROM cust_items ORDER BY numero_unico_conta LIMIT 5"))
def table_sample(spark, sf_dir):
    """First five customer items by key."""
    return J.sample_n(roles.customer_items(spark, sf_dir), 5, "numero_unico_conta")


@register("partition_key_name", with_base("""
SELECT 'year=' || year || '/month=' || month || '/day=' || day AS partition_path,
       replace('year=' || year || '/month=' || month || '/day=' || day, '/', '_') AS partition_name,
       COUNT(*) AS n_rows
FROM tx GROUP BY ALL"""))
def partition_key_name(spark, sf_dir):
    """File-safe names of the discovered partitions."""
    tree = J.scan_tree(spark, jsonl_tree(spark, sf_dir))
    return (tree.groupBy(partition_path().alias("partition_path"))
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select("partition_path", partition_name("partition_path").alias("partition_name"), "n_rows"))


@register("epoch_and_iso", with_base("""
SELECT "codigoLancamento", epoch_us("dataCompletaTransacao") // 1000 AS data_epoch_ms,
       strftime("dataCompletaTransacao", '%Y-%m-%dT%H:%M:%S.%gZ') AS data_iso,
       CAST(epoch_us("dataNascimentoTitularConta") // 1000 AS DOUBLE) AS nascimento_epoch_ms FROM enr"""))
def epoch_and_iso(spark, sf_dir):
    """Document dates as epoch millis (the serialiser default) and as ISO text."""
    docs = enriched(spark, sf_dir)
    return docs.select("codigoLancamento",
                       epoch_millis("dataCompletaTransacao").alias("data_epoch_ms"),
                       iso_millis("dataCompletaTransacao").alias("data_iso"),
                       # nullable (unmatched customers): carried as an exact double
                       epoch_millis("dataNascimentoTitularConta").cast("double").alias("nascimento_epoch_ms"))


@register("file_inventory", with_base("""
SELECT year, month, day, CAST(CASE WHEN day = '15' THEN 2 ELSE 1 END AS BIGINT) AS n_files, true AS has_bytes
FROM tx GROUP BY year, month, day"""))
def file_inventory(spark, sf_dir):
    """Files per partition of a tree with one file a day, and an empty one more on day 15."""
    base = write_partitioned_jsonl(roles.transactions(spark, sf_dir), scratch_path(spark, "txn-inventory"),
                                   files_per_partition=1)
    touch(spark, f"{base}/year=2024/month=01/day=15/empty.json")
    found = file_inventory_of(spark, base)
    return found.select("year", "month", "day", "n_files", (F.col("n_bytes") > 0).alias("has_bytes"))
