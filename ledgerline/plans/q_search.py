"""Step 2: search and analytics over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import currency, money_sum
from ledgerline.operators import search as S
from ledgerline.operators import stats as ST
from ledgerline.plans import roles
from ledgerline.plans.registry import (ENR_COLS_SQL, money_avg_sql, money_sum_sql, pct_sql,
                                       register, with_base)

MATCH_TEXT = "000000012 000000047 000000101"
MATCH_WORDS_SQL = "['000000012', '000000047', '000000101']"
TOKENS_SQL = "regexp_split_to_array(lower(\"nomeTitularConta\"), '[^\\p{L}\\p{N}]+')"


@register("count_docs", with_base("SELECT COUNT(*) AS n_docs FROM enr"))
def count_docs(spark, sf_dir):
    return S.count_docs(roles.stored_documents(spark, sf_dir))


@register("match_all", with_base(
    f'SELECT {ENR_COLS_SQL} FROM enr ORDER BY "codigoLancamento" LIMIT 10'))
def match_all(spark, sf_dir):
    """First page (10 hits) of all documents, ordered by id."""
    return S.search(roles.stored_documents(spark, sf_dir))


@register("term_filter", with_base(
    f"SELECT {ENR_COLS_SQL} FROM enr WHERE \"tipoProdutoTransacao\" = 'PIX' "
    'ORDER BY "codigoLancamento" LIMIT 10'))
def term_filter(spark, sf_dir):
    """Exact keyword filter, default page size."""
    return S.search(roles.stored_documents(spark, sf_dir), term={"tipoProdutoTransacao": "PIX"})


@register("term_total", with_base(
    "SELECT COUNT(*) AS total FROM enr WHERE \"tipoProdutoTransacao\" = 'PIX'"))
def term_total(spark, sf_dir):
    return S.total_hits(roles.stored_documents(spark, sf_dir), term={"tipoProdutoTransacao": "PIX"})


@register("source_fields", with_base(
    'SELECT "codigoLancamento", "valorTotalTransacao", "tipoTransacao" FROM enr'))
def source_fields(spark, sf_dir):
    """``_source`` subset over every document (column pruning reaches the scan)."""
    return S.search(roles.stored_documents(spark, sf_dir), fields=["codigoLancamento", "valorTotalTransacao",
                                                     "tipoTransacao"], size=None)


@register("text_match", with_base(
    f"SELECT {ENR_COLS_SQL} FROM enr WHERE list_has_any({TOKENS_SQL}, {MATCH_WORDS_SQL})"))
def text_match(spark, sf_dir):
    """Analysed match on the holder name: any shared token."""
    return S.search(roles.stored_documents(spark, sf_dir), match={"nomeTitularConta": MATCH_TEXT}, size=None)


@register("range_filter", with_base(
    f"SELECT {ENR_COLS_SQL} FROM enr WHERE \"valorTotalTransacao\" BETWEEN 50 AND 100 "
    "AND \"dataCompletaTransacao\" BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 23:59:59'"))
def range_filter(spark, sf_dir):
    """Range on a double and a date field, all hits."""
    ts = lambda v: F.lit(v).cast("timestamp_ntz")
    rng = {"valorTotalTransacao": (50.0, 100.0),
           "dataCompletaTransacao": (ts("2024-01-10 00:00:00"), ts("2024-01-20 23:59:59"))}
    return S.search(roles.stored_documents(spark, sf_dir), range_=rng, size=None)


def _terms_sql(field: str) -> str:
    return with_base(f'SELECT "{field}", COUNT(*) AS doc_count FROM enr WHERE "{field}" IS NOT NULL '
                     f'GROUP BY "{field}" ORDER BY doc_count DESC, "{field}" ASC LIMIT 10')


@register("terms_tipo", _terms_sql("tipoTransacao"))
def terms_tipo(spark, sf_dir):
    return S.terms_agg(roles.stored_documents(spark, sf_dir), "tipoTransacao")


@register("terms_produto", _terms_sql("tipoProdutoTransacao"))
def terms_produto(spark, sf_dir):
    return S.terms_agg(roles.stored_documents(spark, sf_dir), "tipoProdutoTransacao")


@register("sum_valor", with_base(f'SELECT {money_sum_sql(chr(34) + "valorTotalTransacao" + chr(34))} AS sum_valor FROM enr'))
def sum_valor(spark, sf_dir):
    return S.sum_agg(roles.stored_documents(spark, sf_dir), "valorTotalTransacao", "sum_valor")


@register("avg_valor", with_base(f'SELECT {money_avg_sql(chr(34) + "valorTotalTransacao" + chr(34))} AS avg_valor FROM enr'))
def avg_valor(spark, sf_dir):
    return S.avg_agg(roles.stored_documents(spark, sf_dir), "valorTotalTransacao", "avg_valor")


@register("stats_grouping_sets", with_base(f"""
SELECT "tipoTransacao", "tipoProdutoTransacao",
       CAST(GROUPING("tipoTransacao", "tipoProdutoTransacao") AS INTEGER) AS grouping_id,
       COUNT(*) AS doc_count,
       {money_sum_sql('"valorTotalTransacao"')} AS sum_valor,
       {money_avg_sql('"valorTotalTransacao"')} AS avg_valor
FROM enr GROUP BY GROUPING SETS (("tipoTransacao"), ("tipoProdutoTransacao"), ())"""))
def stats_grouping_sets(spark, sf_dir):
    """Two bucket lists plus global sum and average in one scan."""
    return S.stats(roles.stored_documents(spark, sf_dir))


def _share_sql(field: str) -> str:
    return with_base(f"""
SELECT {field}, n, {pct_sql('n', 'total', 1)} AS pct, printf('%.1f%%', {pct_sql('n', 'total', 1)}) AS pct_text
FROM (SELECT {field}, COUNT(*) AS n, CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS total FROM tx GROUP BY {field})""")


@register("share_by_type", _share_sql("tipo_transacao"))
def share_by_type(spark, sf_dir):
    return ST.share(roles.transactions(spark, sf_dir, with_partitions=False), "tipo_transacao")


@register("share_by_product", _share_sql("tipo_produto_transacao"))
def share_by_product(spark, sf_dir):
    return ST.share(roles.transactions(spark, sf_dir, with_partitions=False), "tipo_produto_transacao")


@register("totals", with_base(f"""
SELECT COUNT(*) AS n_transactions, {money_sum_sql('valor_total_transacao')} AS total_valor,
       {money_avg_sql('valor_total_transacao')} AS avg_valor FROM tx"""))
def totals(spark, sf_dir):
    return ST.totals(roles.transactions(spark, sf_dir, with_partitions=False))


@register("currency_format", with_base(f"""
SELECT tipo_transacao, COUNT(*) AS n_transactions,
       'R$ ' || format('{{:,.2f}}', {money_sum_sql('valor_total_transacao')}) AS total_text
FROM tx GROUP BY tipo_transacao"""))
def currency_format(spark, sf_dir):
    """Grouped currency text of the total value per transaction type."""
    tx = roles.transactions(spark, sf_dir, with_partitions=False)
    return tx.groupBy("tipo_transacao").agg(
        F.count(F.lit(1)).alias("n_transactions"),
        currency(money_sum("valor_total_transacao")).alias("total_text"))
