"""Named queries over the driver's tables and their DuckDB oracle SQL.

Each entry is ``name -> (builder(spark, sf_dir) -> DataFrame, oracle SQL or None)``.
Builders only compose library operators; the oracle restates the same
question in plain SQL over the pre-registered views.  Column names match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import configure

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = (run, oracle)
        return run
    return deco


# ---------------------------------------------------------------------------
# Oracle building blocks (DuckDB dialect).  They restate plans/roles.py.
# ---------------------------------------------------------------------------
TX_SQL = """tx AS (
  SELECT CAST(event_id AS VARCHAR) AS codigo_lancamento,
         CAST(user_id AS VARCHAR) AS numero_unico_conta,
         value AS valor_total_transacao,
         ts AS data_completa_transacao,
         event_type AS tipo_transacao,
         CASE ((CAST(json_extract_string(props, '$.k') AS INTEGER) % 3) + 3) % 3
              WHEN 0 THEN 'PIX' WHEN 1 THEN 'TED' WHEN 2 THEN 'CARTAO' END AS tipo_produto_transacao,
         strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
  FROM events)"""

CUST_ITEMS_SQL = """cust_items AS (
  SELECT CAST(c_custkey AS VARCHAR) AS numero_unico_conta,
         c_name AS nome_titular_conta,
         CASE WHEN c_custkey % 11 = 7 THEN 'not-a-date'
              ELSE strftime(DATE '1945-01-01' + CAST(c_custkey % 20000 AS INTEGER), '%Y-%m-%dT%H:%M:%SZ')
         END AS data_nascimento_titular_conta,
         CASE WHEN c_custkey % 5 = 0 THEN NULL
              ELSE lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') || '-' ||
                   lpad(CAST(c_nationkey % 1000 AS VARCHAR), 3, '0') END AS "zip-code",
         strftime(DATE '2024-01-31' - CAST(c_custkey % 1826 AS INTEGER), '%Y-%m-%d') AS data_criacao_registro
  FROM customer)"""

CUST_SQL = """cust AS (
  SELECT numero_unico_conta, nome_titular_conta,
         try_strptime(data_nascimento_titular_conta, '%Y-%m-%dT%H:%M:%SZ') AS data_nascimento_titular_conta,
         "zip-code" AS zip_code, data_criacao_registro
  FROM cust_items
  WHERE numero_unico_conta IS NOT NULL AND nome_titular_conta IS NOT NULL
    AND data_nascimento_titular_conta IS NOT NULL AND "zip-code" IS NOT NULL
    AND data_criacao_registro IS NOT NULL
    AND try_strptime(data_nascimento_titular_conta, '%Y-%m-%dT%H:%M:%SZ') IS NOT NULL)"""

ENR_SQL = """enr AS (
  SELECT t.codigo_lancamento AS "codigoLancamento", t.numero_unico_conta AS "numeroUnicoConta",
         t.valor_total_transacao AS "valorTotalTransacao", t.data_completa_transacao AS "dataCompletaTransacao",
         t.tipo_transacao AS "tipoTransacao", t.tipo_produto_transacao AS "tipoProdutoTransacao",
         c.nome_titular_conta AS "nomeTitularConta",
         c.data_nascimento_titular_conta AS "dataNascimentoTitularConta", c.zip_code AS "zipCode",
         t.year, t.month, t.day
  FROM tx t LEFT JOIN cust c ON t.numero_unico_conta = c.numero_unico_conta)"""

ENR_COLS_SQL = ('"codigoLancamento", "numeroUnicoConta", "valorTotalTransacao", "dataCompletaTransacao", '
                '"tipoTransacao", "tipoProdutoTransacao", "nomeTitularConta", '
                '"dataNascimentoTitularConta", "zipCode"')
TX_COLS_SQL = ("codigo_lancamento, numero_unico_conta, valor_total_transacao, data_completa_transacao, "
               "tipo_transacao, tipo_produto_transacao")


def with_base(body: str, *extra: str) -> str:
    """Prefix the role CTEs (DuckDB inlines the unused ones)."""
    ctes = [TX_SQL, CUST_ITEMS_SQL, CUST_SQL, ENR_SQL, *extra]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def money_sum_sql(c: str) -> str:
    return f"COALESCE(CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE), 0.0)"


def money_avg_sql(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT({c}) AS DOUBLE)"


def pct_sql(part: str, whole: str, decimals: int = 1) -> str:
    scale = 10 ** decimals
    return (f"CASE WHEN {whole} > 0 THEN CAST((CAST({part} AS BIGINT) * {100 * scale} + "
            f"CAST({whole} AS BIGINT) // 2) // CAST({whole} AS BIGINT) AS DOUBLE) / {float(scale)} END")


def queries() -> dict[str, Builder]:
    _load_all()
    return {name: fn for name, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql is not None}


def _load_all() -> None:
    # Importing the modules registers their queries.
    from ledgerline.plans import (q_core, q_files, q_gen_stream, q_monitor, q_quality,  # noqa: F401
                                  q_search, q_sinks, q_summaries)
