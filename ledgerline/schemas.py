"""Schemas of the three record kinds and the fixed values of the contract."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
TXN_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"          # transaction time text
INSTANT_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSS]X"        # ISO-8601 instant (birth date)
TRANSACTION_TYPES = ("DEBITO", "CREDITO")
PRODUCT_TYPES = ("PIX", "TED", "CARTAO")
LOOKUP_BATCH_KEYS = 100          # keys per dimension lookup request
ENRICH_CHUNK_ROWS = 1000         # rows per enrichment chunk
BULK_BATCH_DOCS = 1000           # documents per bulk request
AMOUNT_CENTS = (1_000, 500_000)
CUSTOMER_AGE_YEARS = (18, 80)
REGISTRATION_AGE_DAYS = (1, 1825)
RETENTION_DAYS = {"infrequent_access": 90, "archive": 180, "expire": 365}
DPU_PER_RUN, PRICE_PER_DPU_HOUR = 2, 0.44
DEFAULT_SEARCH_SIZE = 10
PARTITION_COLS = ("year", "month", "day")

# ---------------------------------------------------------------------------
# Transactions
# ---------------------------------------------------------------------------
TXN_FIELDS = [
    T.StructField("codigo_lancamento", T.StringType()),
    T.StructField("numero_unico_conta", T.StringType()),
    T.StructField("valor_total_transacao", T.DoubleType()),
    T.StructField("data_completa_transacao", T.StringType()),
    T.StructField("tipo_transacao", T.StringType()),
    T.StructField("tipo_produto_transacao", T.StringType()),
]
PARTITION_FIELDS = [T.StructField(c, T.StringType()) for c in PARTITION_COLS]

# JSON as written by the producer; partition columns declared as string so
# zero padding survives and partition filters prune.
TXN_RAW = T.StructType(TXN_FIELDS + PARTITION_FIELDS)
CORRUPT_COL = "_corrupt_record"
TXN_RAW_WITH_CORRUPT = T.StructType(TXN_FIELDS + [T.StructField(CORRUPT_COL, T.StringType())]
                                    + PARTITION_FIELDS)

# Parsed transaction (timestamps are UTC wall clock, TIMESTAMP_NTZ).
TXN = T.StructType([
    T.StructField("codigo_lancamento", T.StringType()),
    T.StructField("numero_unico_conta", T.StringType()),
    T.StructField("valor_total_transacao", T.DoubleType()),
    T.StructField("data_completa_transacao", T.TimestampNTZType()),
    T.StructField("tipo_transacao", T.StringType()),
    T.StructField("tipo_produto_transacao", T.StringType()),
])
TXN_COLS = [f.name for f in TXN.fields]
# Mandatory fields of a transaction; null means the record is quarantined.
TXN_REQUIRED = ("codigo_lancamento", "valor_total_transacao", "data_completa_transacao")

# ---------------------------------------------------------------------------
# Customers
# ---------------------------------------------------------------------------
CUST_RAW = T.StructType([
    T.StructField("numero_unico_conta", T.StringType()),
    T.StructField("nome_titular_conta", T.StringType()),
    T.StructField("data_nascimento_titular_conta", T.StringType()),
    T.StructField("zip-code", T.StringType()),
    T.StructField("data_criacao_registro", T.StringType()),
])
CUST = T.StructType([
    T.StructField("numero_unico_conta", T.StringType()),
    T.StructField("nome_titular_conta", T.StringType()),
    T.StructField("data_nascimento_titular_conta", T.TimestampNTZType()),
    T.StructField("zip_code", T.StringType()),
    T.StructField("data_criacao_registro", T.StringType()),
])
CUST_KEY = "numero_unico_conta"

# ---------------------------------------------------------------------------
# Enriched document (output)
# ---------------------------------------------------------------------------
ENR = T.StructType([
    T.StructField("codigoLancamento", T.StringType()),
    T.StructField("numeroUnicoConta", T.StringType()),
    T.StructField("valorTotalTransacao", T.DoubleType()),
    T.StructField("dataCompletaTransacao", T.TimestampNTZType()),
    T.StructField("tipoTransacao", T.StringType()),
    T.StructField("tipoProdutoTransacao", T.StringType()),
    T.StructField("nomeTitularConta", T.StringType()),
    T.StructField("dataNascimentoTitularConta", T.TimestampNTZType()),
    T.StructField("zipCode", T.StringType()),
])
ENR_COLS = [f.name for f in ENR.fields]
DOC_KEY = "codigoLancamento"
DOCS_SCHEMA = T.StructType(ENR.fields + [T.StructField(c, T.StringType()) for c in ("year", "month", "day")])

# ---------------------------------------------------------------------------
# Alarm rules.  Name: metric, statistic, period seconds,
# comparison, threshold, evaluation periods.  Missing periods never breach.
# ---------------------------------------------------------------------------
ALARM_RULES = {
    "failed_tasks": ("glue.driver.aggregate.numFailedTasks", "sum", 300, ">", 0.0, 1),
    "read_throttle": ("ReadThrottleEvents", "sum", 300, ">", 10.0, 2),
    "write_throttle": ("WriteThrottleEvents", "sum", 300, ">", 10.0, 2),
    "status_red": ("ClusterStatus.red", "max", 60, ">=", 1.0, 1),
    "status_yellow": ("ClusterStatus.yellow", "max", 60, ">=", 1.0, 1),
    "free_space": ("FreeStorageSpace", "min", 60, "<", 2000.0, 1),
    "cpu": ("CPUUtilization", "avg", 300, ">", 80.0, 3),
}
