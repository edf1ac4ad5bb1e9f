"""Step 4: sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import quality as Q
from ledgerline.operators import sinks as K
from ledgerline.operators.documents import to_bulk_ndjson
from ledgerline.operators.summaries import missing_by_digest
from ledgerline.plans import roles
from ledgerline.plans.q_core import enriched
from ledgerline.plans.registry import ENR_COLS_SQL, money_sum_sql, register, with_base
from ledgerline.schemas import CUST, DOCS_SCHEMA, ENR, ENR_COLS, PARTITION_COLS
from ledgerline.session import path_exists, scratch_path
from ledgerline.sources.json_files import scan_tree

DOC_ORDER = ["dataCompletaTransacao", "valorTotalTransacao"]

LINEITEM_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
LINEITEM_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_returnflag", "l_linestatus", "l_shipdate"]


def docs_with_partitions(spark, sf_dir, start=None, end=None):
    return enriched(spark, sf_dir, start, end, keep=PARTITION_COLS)


def read_docs(spark, path):
    return K.read_table(spark, path, DOCS_SCHEMA)


@register("upsert_dedupe", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
    """ + ", ".join(f"{c} DESC NULLS LAST" for c in LINEITEM_ORDER + LINEITEM_REST) + """) AS rn
  FROM lineitem) WHERE rn = 1""")
def upsert_dedupe(spark, sf_dir):
    """Latest line per (order, line number) under a total order."""
    li = roles.table(spark, sf_dir, "lineitem")
    return K.latest_per_key(li, ["l_orderkey", "l_linenumber"], LINEITEM_ORDER)


@register("upsert_rerun", with_base(f"""
SELECT "codigoLancamento", "numeroUnicoConta",
       CASE WHEN "dataCompletaTransacao" >= TIMESTAMP '2024-01-15 00:00:00' THEN "valorTotalTransacao" + 1
            ELSE "valorTotalTransacao" END AS "valorTotalTransacao",
       "dataCompletaTransacao", "tipoTransacao", "tipoProdutoTransacao", "nomeTitularConta",
       "dataNascimentoTitularConta", "zipCode" FROM enr"""))
def upsert_rerun(spark, sf_dir):
    """Days 1-20 loaded, then days 15-30 with new amounts upserted twice: replace, never duplicate."""
    target = scratch_path(spark, "docs-upsert")
    K.upsert(spark, target, docs_with_partitions(spark, sf_dir, end="2024-01-21 00:00:00"),
             order_by=DOC_ORDER)
    batch = docs_with_partitions(spark, sf_dir, start="2024-01-15 00:00:00").withColumn(
        "valorTotalTransacao", F.col("valorTotalTransacao") + 1)
    K.upsert(spark, target, batch, order_by=DOC_ORDER)
    K.upsert(spark, target, batch, order_by=DOC_ORDER)
    return read_docs(spark, target).select(*ENR_COLS)


@register("upsert_null_partition", with_base("""
SELECT codigo_lancamento, day, CASE WHEN day = 'a/b:c' THEN 'x' END AS extra, canal FROM (
  SELECT codigo_lancamento, CASE WHEN k % 7 = 1 THEN NULL WHEN k % 7 = 2 THEN 'a/b:c' ELSE day END AS day,
         CASE WHEN k % 7 = 1 THEN 'second' END AS canal
  FROM (SELECT *, CAST(codigo_lancamento AS BIGINT) AS k FROM tx))"""))
def upsert_null_partition(spark, sf_dir):
    """A month loaded, then every 7th document again without a day and with a new column: the other
    days stay whole, so does a stored column that the second batch lacks, and a day whose value needs
    escaping in a path."""
    target = scratch_path(spark, "docs-null-day")
    tx = roles.transactions(spark, sf_dir).select("codigo_lancamento", *PARTITION_COLS)
    k = F.col("codigo_lancamento").cast("long") % 7
    odd = tx.withColumn("day", F.when(k == 2, F.lit("a/b:c")).otherwise(F.col("day")))
    K.upsert(spark, target, odd.withColumn("extra", F.when(F.col("day") == "a/b:c", F.lit("x"))), key="codigo_lancamento")
    again = tx.where(k == 1).withColumn("day", F.lit(None).cast("string")).withColumn("canal", F.lit("second"))
    K.upsert(spark, target, again, key="codigo_lancamento")
    schema = K.table_schema(spark, target, {})
    return K.read_table(spark, target, schema).select("codigo_lancamento", "day", "extra", "canal")


@register("customer_upsert", with_base("""
SELECT numero_unico_conta,
       CASE WHEN data_criacao_registro >= '2023-06-01' THEN upper(nome_titular_conta)
            ELSE nome_titular_conta END AS nome_titular_conta,
       data_nascimento_titular_conta, zip_code, data_criacao_registro FROM cust"""))
def customer_upsert(spark, sf_dir):
    """Customer table put by key: a second load replaces the re-registered items
    (hash-bucketed table: each load rewrites only the buckets it touches)."""
    target = scratch_path(spark, "customers")
    cust = roles.customers(spark, sf_dir)
    K.upsert_bucketed(spark, target, cust, key="numero_unico_conta")
    again = (cust.where(F.col("data_criacao_registro") >= "2023-06-01")
             .withColumn("nome_titular_conta", F.upper("nome_titular_conta")))
    K.upsert_bucketed(spark, target, again, key="numero_unico_conta")
    return K.read_bucketed(spark, target, CUST)


@register("union_last_wins", """
SELECT c_custkey, c_acctbal, batch_no FROM (
  SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY batch_no DESC) AS rn FROM (
    SELECT c_custkey, c_acctbal, 0 AS batch_no FROM customer
    UNION ALL SELECT c_custkey, c_acctbal + 1, 1 FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL SELECT c_custkey, c_acctbal + 2, 2 FROM customer WHERE c_nationkey < 5))
WHERE rn = 1""")
def union_last_wins(spark, sf_dir):
    """Three lookup responses; the later response wins per key."""
    c = roles.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment",
                                                      "c_nationkey")
    b0 = c.select("c_custkey", "c_acctbal")
    b1 = c.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey", (F.col("c_acctbal") + 1).alias("c_acctbal"))
    b2 = c.where(F.col("c_nationkey") < 5).select("c_custkey", (F.col("c_acctbal") + 2).alias("c_acctbal"))
    return K.union_last_wins([b0, b1, b2], "c_custkey").select(
        "c_custkey", "c_acctbal", F.col("_batch").alias("batch_no"))


def _doc_json_sql(date_fn) -> str:
    parts = []
    for f in ENR.fields:
        v = f'"{f.name}"'
        if isinstance(f.dataType, T.TimestampNTZType):
            v = date_fn(v)
        parts.append(f"'{f.name}', {v}")
    return "json_object(" + ", ".join(parts) + ")"


@register("bulk_ndjson", with_base(f"""
SELECT "codigoLancamento", 0 AS line_no,
       CAST(json_object('index', json_object('_index', 'transactions', '_id', "codigoLancamento")) AS VARCHAR) AS line
FROM enr
UNION ALL
SELECT "codigoLancamento", 1 AS line_no, CAST({_doc_json_sql(lambda v: f'epoch_us({v}) // 1000')} AS VARCHAR) AS line
FROM enr"""))
def bulk_ndjson(spark, sf_dir):
    """Action + document line per document, dates as epoch millis, absent customer as null."""
    return to_bulk_ndjson(enriched(spark, sf_dir), "transactions")


@register("bulk_batches", with_base("""
SELECT year, month, day, bucket, batch_no, COUNT(*) AS n_docs FROM (
  SELECT year, month, day, bucket,
         CAST((row_number() OVER (PARTITION BY year, month, day, bucket ORDER BY "codigoLancamento") - 1) // 1000 AS BIGINT) AS batch_no
  FROM (SELECT *, ('0x' || substr(md5("codigoLancamento"), 1, 8))::BIGINT % 16 AS bucket FROM enr))
GROUP BY ALL"""))
def bulk_batches(spark, sf_dir):
    """Bulk requests of at most 1000 documents inside (day, id bucket) groups of the stored documents."""
    return K.assign_batches(read_docs(spark, roles.stored_target(spark, sf_dir)), 1000, PARTITION_COLS)


@register("write_metrics", with_base(f"""
SELECT COUNT(*) AS rows_written, COUNT("nomeTitularConta") AS rows_matched,
       {money_sum_sql('"valorTotalTransacao"')} AS total_valor FROM enr"""))
def write_metrics(spark, sf_dir):
    """Counts observed during the documents' write (no second scan)."""
    target = scratch_path(spark, "docs-write")
    m = K.write_with_metrics(docs_with_partitions(spark, sf_dir),
                             lambda d: d.write.partitionBy(*PARTITION_COLS).parquet(target))
    return spark.createDataFrame([(m["rows_written"], m["rows_matched"], m["total_valor"])],
                                 "rows_written long, rows_matched long, total_valor double")


@register("index_readback", with_base(f"SELECT {ENR_COLS_SQL} FROM enr"))
def index_readback(spark, sf_dir):
    """Every stored document read back from the target."""
    target = scratch_path(spark, "docs-index")
    K.upsert(spark, target, docs_with_partitions(spark, sf_dir), order_by=DOC_ORDER)
    return read_docs(spark, target).select(*ENR_COLS)


def _table_name() -> str:
    return f"ledgerline_docs_{uuid.uuid4().hex[:10]}"


@register("ensure_table_idempotent", with_base(
    "SELECT true AS created_first, false AS created_second, COUNT(*) AS n_docs FROM enr"))
def ensure_table_idempotent(spark, sf_dir):
    """Create-if-absent twice around a load: the second call leaves the data alone."""
    name, loc = _table_name(), scratch_path(spark, "docs-table")
    first = K.ensure_table(spark, name, DOCS_SCHEMA, loc, PARTITION_COLS)
    docs_with_partitions(spark, sf_dir).select(*DOCS_SCHEMA.fieldNames()).write.insertInto(name)
    second = K.ensure_table(spark, name, DOCS_SCHEMA, loc, PARTITION_COLS)
    n = spark.table(name).count()
    K.drop_table(spark, name)
    return spark.createDataFrame([(first, second, n)],
                                 "created_first boolean, created_second boolean, n_docs long")


@register("drop_table", with_base(
    "SELECT true AS existed, COUNT(*) AS n_docs, false AS exists_after, false AS files_after FROM enr"))
def drop_table(spark, sf_dir):
    """Delete the target: catalog entry and files are gone afterwards."""
    name, loc = _table_name(), scratch_path(spark, "docs-table")
    K.ensure_table(spark, name, DOCS_SCHEMA, loc, PARTITION_COLS)
    docs_with_partitions(spark, sf_dir).select(*DOCS_SCHEMA.fieldNames()).write.insertInto(name)
    n = spark.table(name).count()
    existed = K.drop_table(spark, name)
    return spark.createDataFrame(
        [(existed, n, spark.catalog.tableExists(name), path_exists(spark, loc))],
        "existed boolean, n_docs long, exists_after boolean, files_after boolean")


AS_OF_TIERS, AS_OF_EXPIRE = "2025-01-05", "2025-01-20"


@register("retention_tiers", with_base(f"""
SELECT year, month, day, CAST(date_diff('day', make_date(CAST(year AS INTEGER), CAST(month AS INTEGER),
       CAST(day AS INTEGER)), DATE '{AS_OF_TIERS}') AS INTEGER) AS age_days,
       CASE WHEN age_days >= 365 THEN 'expired' WHEN age_days >= 180 THEN 'archive'
            WHEN age_days >= 90 THEN 'infrequent_access' ELSE 'standard' END AS tier,
       COUNT(*) AS n_rows
FROM tx GROUP BY year, month, day"""))
def retention_tiers(spark, sf_dir):
    """Storage tier of each day partition as of 2025-01-05."""
    return K.retention_tiers(roles.transactions(spark, sf_dir), AS_OF_TIERS)


@register("retention_expire", with_base(f"""
SELECT year, month, day, COUNT(*) AS n_rows FROM tx
WHERE date_diff('day', make_date(CAST(year AS INTEGER), CAST(month AS INTEGER), CAST(day AS INTEGER)),
                DATE '{AS_OF_EXPIRE}') < 365
GROUP BY year, month, day"""))
def retention_expire(spark, sf_dir):
    """Partitions 365+ days old (as of 2025-01-20) deleted; what remains per day."""
    target = scratch_path(spark, "docs-retention")
    docs_with_partitions(spark, sf_dir).write.partitionBy(*PARTITION_COLS).parquet(target)
    K.expire(spark, target, AS_OF_EXPIRE)
    return read_docs(spark, target).groupBy(*PARTITION_COLS).agg(F.count(F.lit(1)).alias("n_rows"))


def _indexed_until_28(spark, sf_dir):
    """The landed tree of every day, and a target that lacks the days after the 28th: the missing rows
    are what the reconciliation has to find."""
    target = scratch_path(spark, "docs-reconcile")
    K.upsert(spark, target, docs_with_partitions(spark, sf_dir, end="2024-01-29 00:00:00"), order_by=DOC_ORDER)
    return scan_tree(spark, roles.landed_tree(spark, sf_dir)), read_docs(spark, target)


@register("reconcile_counts", with_base("""
SELECT year, month, day, COUNT(*) AS source_rows,
       COUNT(*) FILTER (WHERE day <= '28') AS indexed_docs,
       COUNT(*) FILTER (WHERE day > '28') AS missing_docs
FROM tx GROUP BY year, month, day"""))
def reconcile_counts(spark, sf_dir):
    """Per day: source rows, indexed documents, missing documents."""
    source, target = _indexed_until_28(spark, sf_dir)
    return Q.reconcile(source, target.withColumnRenamed("codigoLancamento", "codigo_lancamento"),
                       "codigo_lancamento")


@register("reconcile_missing", with_base(
    "SELECT codigo_lancamento, year, month, day FROM tx WHERE day > '28'"))
def reconcile_missing(spark, sf_dir):
    """Source ids that never reached the target; days with equal digests are not read again."""
    source, target = _indexed_until_28(spark, sf_dir)
    return missing_by_digest(source, target.withColumnRenamed("codigoLancamento", "codigo_lancamento"), "codigo_lancamento")


@register("verify_count", with_base("""
SELECT (SELECT COUNT(*) FROM cust_items) AS expected, (SELECT COUNT(*) FROM cust) AS actual,
       (SELECT COUNT(*) FROM cust) >= (SELECT COUNT(*) FROM cust_items) AS ok"""))
def verify_count(spark, sf_dir):
    """Loaded customers vs items offered (rejected items make it fail)."""
    target = scratch_path(spark, "customers-verify")
    K.upsert_bucketed(spark, target, roles.customers(spark, sf_dir), key="numero_unico_conta")
    return Q.verify_count(K.read_bucketed(spark, target, CUST), roles.customer_items(spark, sf_dir))
