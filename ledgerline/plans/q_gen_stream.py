"""Steps 7-9: generation (G1, G2), streaming (T1-T4), user-function lookup (B1)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import generate as G
from ledgerline.operators.lookup_udf import batched_lookup, send_batches
from ledgerline.operators.sinks import read_table, txn_line, write_jsonl
from ledgerline.plans import roles
from ledgerline.plans.q_files import TXR_COLS, TXR_SQL
from ledgerline.plans.registry import money_sum_sql, register, with_base
from ledgerline.schemas import DOCS_SCHEMA, ENR_COLS, PARTITION_COLS, TXN_RAW
from ledgerline.session import scratch_path
from ledgerline.sources.json_files import parse_raw
from ledgerline.streaming import ingest as ST


def _uuid_sql(expr: str) -> str:
    h = f"md5({expr})"
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
            f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12)")


def _draw_sql(name: str, ids: str, n: str) -> str:
    return f"(('0x' || substr(md5('0:{name}:' || CAST({ids} AS VARCHAR)), 1, 15))::BIGINT % ({n}))"


@register("gen_customers", f"""
SELECT {_uuid_sql("'c' || CAST(c_custkey AS VARCHAR)")} AS numero_unico_conta,
       'Titular ' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS nome_titular_conta,
       strftime(DATE '1944-01-31' + CAST({_draw_sql("birth", "c_custkey", "date_diff('day', DATE '1944-01-31', DATE '2006-01-31') + 1")} AS INTEGER),
                '%Y-%m-%dT%H:%M:%SZ') AS data_nascimento_titular_conta,
       lpad(CAST({_draw_sql("zip", "c_custkey", "100000")} AS VARCHAR), 5, '0') || '-' ||
       lpad(CAST({_draw_sql("zip3", "c_custkey", "1000")} AS VARCHAR), 3, '0') AS "zip-code",
       strftime(DATE '2024-01-31' - CAST({_draw_sql("created", "c_custkey", "1825")} + 1 AS INTEGER), '%Y-%m-%d') AS data_criacao_registro
FROM customer""")
def gen_customers(spark, sf_dir):
    """One generated customer item per customer key."""
    ids = roles.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return G.gen_customers(ids)


@register("gen_transactions", f"""
SELECT {_uuid_sql("'t' || CAST(event_id AS VARCHAR)")} AS codigo_lancamento, a.numero_unico_conta,
       CAST({_draw_sql("amount", "event_id", "499001")} + 1000 AS DOUBLE) / 100.0 AS valor_total_transacao,
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds({_draw_sql("day", "event_id", "31")} * 86400 + {_draw_sql("second", "event_id", "86400")})
         AS data_completa_transacao,
       CASE WHEN {_draw_sql("type", "event_id", "2")} = 0 THEN 'DEBITO' ELSE 'CREDITO' END AS tipo_transacao,
       CASE {_draw_sql("product", "event_id", "3")} WHEN 0 THEN 'PIX' WHEN 1 THEN 'TED' ELSE 'CARTAO' END AS tipo_produto_transacao,
       strftime(data_completa_transacao, '%Y') AS year, strftime(data_completa_transacao, '%m') AS month,
       strftime(data_completa_transacao, '%d') AS day
FROM events JOIN (SELECT CAST(c_custkey AS VARCHAR) AS numero_unico_conta,
                         row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) - 1 AS no FROM customer) a
  ON a.no = {_draw_sql("account", "event_id", "SELECT COUNT(*) FROM customer")}""")
def gen_transactions(spark, sf_dir):
    """One generated transaction per event id, January 2024, accounts from the customer table."""
    ids = roles.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    return G.gen_transactions(ids, roles.customer_items(spark, sf_dir), "2024-01-01", "2024-01-31")


TXR_ENR_SQL = f"""SELECT "codigoLancamento", "numeroUnicoConta", "valorTotalTransacao",
       date_trunc('second', "dataCompletaTransacao") AS "dataCompletaTransacao", "tipoTransacao",
       "tipoProdutoTransacao", "nomeTitularConta", "dataNascimentoTitularConta", "zipCode" FROM enr"""


#: Files per micro-batch: the trees of these queries arrive in several, days out of order.
FILES = 12
#: Ids whose line was cut off when it was written, and rows that are left.
BAD_SQL = "CAST(\"codigoLancamento\" AS BIGINT) % 97 = 0"
BAD_TX_SQL = "CAST(codigo_lancamento AS BIGINT) % 97 = 0"


def dirty_tree(spark, sf_dir, deliveries: int = 1) -> str:
    """A private tree, ``deliveries`` times over, in which every 97th id's line is cut off; the later
    days are written first, so that files do not arrive in the order of their events."""
    base = scratch_path(spark, "txn-dirty")
    tx = roles.transactions(spark, sf_dir)
    bad = F.col("codigo_lancamento").cast("long") % 97 == 0
    lines = tx.select(F.when(bad, F.lit('{"codigo')).otherwise(txn_line()).alias("value"), "codigo_lancamento", *PARTITION_COLS)
    for _ in range(deliveries):
        for days in (F.col("day") > "15", F.col("day") <= "15"):
            write_jsonl(lines.where(days), base, key="codigo_lancamento", files_per_partition=1, mode="append")
    return base


def with_quarantined(spark, df, quarantine):
    """Every row with the number of quarantined lines: kept and quarantined rows account for the source."""
    n = spark.read.schema("reason string").option("recursiveFileLookup", "true").json(quarantine).count()
    return df.withColumn("n_quarantined", F.lit(n).cast("long"))


def _counted_sql(sql: str, deliveries: int = 1) -> str:
    return f"SELECT *, (SELECT {deliveries} * COUNT(*) FROM tx WHERE {BAD_TX_SQL}) AS n_quarantined FROM ({sql})"


@register("stream_ingest", with_base(_counted_sql(TXR_ENR_SQL + f" WHERE NOT {BAD_SQL}")))
def stream_ingest(spark, sf_dir):
    """Files picked up in several micro-batches, bad lines quarantined, documents upserted."""
    base, target, bad = dirty_tree(spark, sf_dir), scratch_path(spark, "stream-target"), scratch_path(spark, "stream-bad")
    ST.stream_ingest(spark, base, target, scratch_path(spark, "ckpt"), roles.customers(spark, sf_dir), bad,
                     max_files_per_trigger=FILES)
    return with_quarantined(spark, read_table(spark, target, DOCS_SCHEMA).select(*ENR_COLS), bad)


@register("stream_enrich", with_base(_counted_sql(TXR_ENR_SQL + f" WHERE NOT {BAD_SQL}")))
def stream_enrich(spark, sf_dir):
    """Stream-static enrichment by micro-batch, bad lines apart, one query."""
    base, out, bad = dirty_tree(spark, sf_dir), scratch_path(spark, "stream-docs"), scratch_path(spark, "stream-bad")
    ST.stream_enrich(spark, base, out, scratch_path(spark, "ckpt"), roles.customers(spark, sf_dir), bad,
                     max_files_per_trigger=FILES)
    return with_quarantined(spark, read_table(spark, out, DOCS_SCHEMA).select(*ENR_COLS), bad)


def _txn_schema(spark, base):
    return T.StructType([f for f in parse_raw(spark.read.schema(TXN_RAW).json(base)).schema.fields])


@register("stream_dedupe", with_base(_counted_sql(f"SELECT {TXR_COLS} FROM txr WHERE NOT {BAD_TX_SQL}", 2), TXR_SQL))
def stream_dedupe(spark, sf_dir):
    """Every file delivered twice, with a watermark of one hour: rows kept and rows that came too late,
    one per id together, are the source."""
    base, out = dirty_tree(spark, sf_dir, 2), scratch_path(spark, "stream-dedupe")
    late, bad = scratch_path(spark, "stream-late"), scratch_path(spark, "stream-bad")
    ST.stream_dedupe_into(spark, base, out, scratch_path(spark, "ckpt"), bad, late, max_files_per_trigger=FILES)
    schema = _txn_schema(spark, base)
    kept = read_table(spark, out, schema)
    too_late = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(late).join(
        kept.select("codigo_lancamento"), "codigo_lancamento", "left_anti").dropDuplicates(["codigo_lancamento"])
    return with_quarantined(spark, kept.unionByName(too_late), bad)


@register("stream_dedupe_insert", with_base(_counted_sql(f"SELECT {TXR_COLS} FROM txr WHERE NOT {BAD_TX_SQL}", 2), TXR_SQL))
def stream_dedupe_insert(spark, sf_dir):
    """Every file delivered twice, over several micro-batches; insert-if-absent keeps one copy however late."""
    base, out, bad = dirty_tree(spark, sf_dir, 2), scratch_path(spark, "stream-dedupe-insert"), scratch_path(spark, "stream-bad")
    ST.stream_dedupe_into(spark, base, out, scratch_path(spark, "ckpt"), bad, max_files_per_trigger=FILES)
    return with_quarantined(spark, read_table(spark, out, _txn_schema(spark, base)), bad)


@register("stream_tumbling", with_base(_counted_sql(f"""
SELECT tipo_transacao, time_bucket(INTERVAL '900 seconds', date_trunc('second', data_completa_transacao)) AS window_start,
       COUNT(*) AS n_transactions, {money_sum_sql('valor_total_transacao')} AS sum_valor
FROM tx WHERE NOT {BAD_TX_SQL} GROUP BY ALL""")))
def stream_tumbling(spark, sf_dir):
    """15-minute count and volume per type over several micro-batches, days out of order."""
    base, target, bad = dirty_tree(spark, sf_dir), scratch_path(spark, "stream-windows"), scratch_path(spark, "stream-bad")
    ST.stream_tumbling(spark, base, target, scratch_path(spark, "ckpt"), bad, max_files_per_trigger=FILES)
    return with_quarantined(spark, ST.window_totals(spark, target), bad)


class RuleFetch:
    """A user's lookup: accounts 0 to ``n`` - 1 exist, and their attributes follow from the number."""

    def __init__(self, n: int):
        self.n = n

    def __call__(self, keys: list) -> pd.DataFrame:
        known = [k for k in keys if k.isdigit() and int(k) < self.n]
        return pd.DataFrame({"numero_unico_conta": known, "faixa": [int(k) % 11 for k in known],
                             "agencia": [f"{int(k) % 100000:05d}" for k in known]})


@register("batched_lookup_udf", with_base("""
SELECT codigo_lancamento, t.numero_unico_conta, faixa, agencia FROM tx t LEFT JOIN (
  SELECT CAST(c_custkey AS VARCHAR) AS numero_unico_conta, (c_custkey % 11)::DOUBLE AS faixa,
         lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS agencia FROM customer) c
ON t.numero_unico_conta = c.numero_unico_conta"""))
def batched_lookup_udf(spark, sf_dir):
    """Attributes from a user's function in chunks of keys; must equal a left join."""
    n = roles.table(spark, sf_dir, "customer").count()
    txn = roles.transactions(spark, sf_dir, with_partitions=False).select("codigo_lancamento", "numero_unico_conta")
    return batched_lookup(txn, RuleFetch(n), "numero_unico_conta",
                          T.StructType([T.StructField("numero_unico_conta", T.StringType()),
                                        T.StructField("faixa", T.DoubleType()), T.StructField("agencia", T.StringType())]))


@register("batched_write", with_base("""
SELECT COUNT(*) AS rows_sent, CAST(SUM(CAST(codigo_lancamento AS BIGINT)) AS BIGINT) AS id_sum FROM tx"""))
def batched_write(spark, sf_dir):
    """Rows handed to a user's sender in batches of at most 1000; what it received adds up to the table."""
    def send(part: pd.DataFrame) -> dict:
        if len(part) > 1000:
            raise ValueError("batch too large")
        return {"rows_sent": len(part), "id_sum": int(part["codigo_lancamento"].astype("int64").sum())}

    sent = send_batches(roles.transactions(spark, sf_dir, with_partitions=False).select("codigo_lancamento"),
                        send, "rows_sent long, id_sum long", 1000)
    return sent.agg(F.sum("rows_sent").alias("rows_sent"), F.sum("id_sum").alias("id_sum"))
