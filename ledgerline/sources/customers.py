"""Strict customer parse into valid and rejected records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import parse_instant

_ATTRS = ("numero_unico_conta", "nome_titular_conta", "data_nascimento_titular_conta",
          "zip-code", "data_criacao_registro")


def customer_reason(df: DataFrame):
    """Why an item is rejected (first failing rule), or null when valid."""
    reason = None
    for attr in _ATTRS:
        cond = F.col(f"`{attr}`").isNull()
        reason = F.when(cond, F.lit(f"missing:{attr}")) if reason is None else reason.when(
            cond, F.lit(f"missing:{attr}"))
    return reason.when(parse_instant("data_nascimento_titular_conta").isNull(),
                       F.lit("birth_date"))


def load_customers(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split raw items (CUST_RAW) into (valid CUST, rejected items + ``reason``).

    One projection computes the reason; both outputs are filters of it, so a
    caller that writes both should persist/checkpoint ``items`` first.
    """
    tagged = items.withColumn("reason", customer_reason(items))
    valid = tagged.where(F.col("reason").isNull()).select(
        "numero_unico_conta", "nome_titular_conta",
        parse_instant("data_nascimento_titular_conta").alias("data_nascimento_titular_conta"),
        F.col("`zip-code`").alias("zip_code"), "data_criacao_registro")
    rejected = tagged.where(F.col("reason").isNotNull())
    return valid, rejected


def parse_customers(items: DataFrame) -> DataFrame:
    """All items with parsed columns, ``status`` (valid/rejected) and ``reason``."""
    reason = customer_reason(items)
    return items.select(
        "numero_unico_conta", "nome_titular_conta",
        parse_instant("data_nascimento_titular_conta").alias("data_nascimento_titular_conta"),
        F.col("`zip-code`").alias("zip_code"),
        F.when(reason.isNull(), "valid").otherwise("rejected").alias("status"),
        reason.alias("reason"))
