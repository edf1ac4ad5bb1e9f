"""Search-store queries re-expressed as DataFrame plans.

Semantics kept from the search API: default page size 10, term filters are
exact equality, text match is OR over analysed tokens, terms buckets skip
nulls and sort by count desc then key asc, sum of nothing is 0, average of
nothing is null.  Hits with equal relevance have no defined order there; here
they are ordered by document id so pages are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import money_avg, money_sum
from ledgerline.schemas import DEFAULT_SEARCH_SIZE, DOC_KEY

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def tokens(c) -> Column:
    """Analysed tokens: lower-cased, split on anything that is not a letter or digit."""
    c = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(F.lower(c), TOKEN_SPLIT), lambda t: t != "")


def text_match(field: str, text: str) -> Column:
    """True when the field shares at least one token with ``text``."""
    return F.arrays_overlap(tokens(field), tokens(F.lit(text)))


def search(df: DataFrame, term: dict | None = None, match: dict | None = None,
           range_: dict | None = None, fields=None, size: int | None = DEFAULT_SEARCH_SIZE,
           sort_key: str = DOC_KEY) -> DataFrame:
    """Filter, order by id, take ``size`` hits, project ``fields``."""
    out = df
    for f, v in (term or {}).items():
        out = out.where(F.col(f) == F.lit(v))
    for f, text in (match or {}).items():
        out = out.where(text_match(f, text))
    for f, (lo, hi) in (range_ or {}).items():
        if lo is not None:
            out = out.where(F.col(f) >= F.lit(lo))
        if hi is not None:
            out = out.where(F.col(f) <= F.lit(hi))
    if size is not None:
        out = out.orderBy(F.col(sort_key).asc_nulls_last()).limit(size)
    if fields:
        out = out.select(*fields)
    return out


def total_hits(df: DataFrame, term: dict | None = None, match: dict | None = None,
               range_: dict | None = None) -> DataFrame:
    """Number of matching documents (``hits.total``)."""
    return search(df, term, match, range_, size=None).agg(F.count(F.lit(1)).alias("total"))


def count_docs(df: DataFrame) -> DataFrame:
    """A1: ``_count``."""
    return df.agg(F.count(F.lit(1)).alias("n_docs"))


def terms_agg(df: DataFrame, field: str, size: int = DEFAULT_SEARCH_SIZE) -> DataFrame:
    """A2/L3: top ``size`` buckets; partial counts are combined map-side."""
    return (df.where(F.col(field).isNotNull()).groupBy(field)
            .agg(F.count(F.lit(1)).alias("doc_count"))
            .orderBy(F.col("doc_count").desc(), F.col(field).asc())
            .limit(size))


def sum_agg(df: DataFrame, field: str, alias: str = "sum_value") -> DataFrame:
    """A3: exact sum of a 2-decimal field, 0 on empty."""
    return df.agg(money_sum(field).alias(alias))


def avg_agg(df: DataFrame, field: str, alias: str = "avg_value") -> DataFrame:
    """A4: average, null on empty (display layers print 0)."""
    return df.agg(money_avg(field).alias(alias))


def stats(df: DataFrame, by=("tipoTransacao", "tipoProdutoTransacao"),
          value: str = "valorTotalTransacao") -> DataFrame:
    """A5: one scan answers each single-field bucket list plus the global sum/avg.

    ``GROUPING SETS ((a), (b), ())`` -> an Expand feeding one partial/final
    aggregate; ``grouping_id`` tells the sets apart.
    """
    sets = [[F.col(c)] for c in by] + [[]]
    return df.groupingSets(sets, *[F.col(c) for c in by]).agg(
        F.grouping_id(*by).cast("int").alias("grouping_id"),
        F.count(F.lit(1)).alias("doc_count"),
        money_sum(value).alias("sum_valor"),
        money_avg(value).alias("avg_valor"))
