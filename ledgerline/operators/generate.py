"""Synthetic producers (G1, G2) as distributed jobs.

Every attribute is drawn by its own hash of (seed, attribute, row id), so the output is deterministic,
reproducible in SQL, independent between attributes, and each executor generates its own slice: the
id DataFrame (e.g. ``spark.range(n)`` or the ids of an existing table) is the only input, plus the
customer table from which accounts are drawn.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import partition_keys, stable_uuid
from ledgerline.schemas import AMOUNT_CENTS, CUST_KEY, CUSTOMER_AGE_YEARS, REGISTRATION_AGE_DAYS
from ledgerline.session import scratch_path


def draw(seed: int, name: str, ids: Column, n: Column | int) -> Column:
    """Integer in [0, n): 60 bits of the md5 of ``seed:name:id``, modulo n."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{name}:"), ids.cast("string")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), n if isinstance(n, Column) else F.lit(n))


def account_key(idx) -> Column:
    """Account id of generated customer ``idx``."""
    return stable_uuid(F.concat(F.lit("c"), idx.cast("string")))


def gen_customers(ids: DataFrame, as_of: str = "2024-01-31", id_col: str = "id", seed: int = 0) -> DataFrame:
    """G1: one raw customer item (CUST_RAW) per id: a birth date between exactly 80 and exactly 18 years
    before ``as_of``, registered 1 to 1825 days before it."""
    i = F.col(id_col).cast("long")
    today = F.lit(as_of).cast("date")
    youngest, oldest = (F.add_months(today, -12 * years) for years in CUSTOMER_AGE_YEARS)
    birth = F.date_add(oldest, draw(seed, "birth", i, F.datediff(youngest, oldest) + 1).cast("int"))
    first, last = REGISTRATION_AGE_DAYS
    created = F.date_sub(today, (draw(seed, "created", i, last - first + 1) + first).cast("int"))
    zip_code = F.concat(F.lpad(draw(seed, "zip", i, 100000).cast("string"), 5, "0"), F.lit("-"),
                        F.lpad(draw(seed, "zip3", i, 1000).cast("string"), 3, "0"))
    return ids.select(account_key(i).alias("numero_unico_conta"),
                      F.concat(F.lit("Titular "), F.lpad(i.cast("string"), 9, "0")).alias("nome_titular_conta"),
                      F.date_format(birth, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("data_nascimento_titular_conta"),
                      zip_code.alias("zip-code"),
                      F.date_format(created, "yyyy-MM-dd").alias("data_criacao_registro"))


def numbered(df: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Distinct values of ``key`` with their rank from 0 (column ``_no``), and how many there are.

    Values are range-partitioned and numbered inside each partition; the counts before a partition, one row
    each, are joined."""
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    rows = df.select(key).where(F.col(key).isNotNull()).distinct().repartitionByRange(key)
    in_part = Window.partitionBy("_part").orderBy(key)
    rows.withColumn("_part", F.spark_partition_id()).withColumn("_no", F.row_number().over(in_part).cast("long") - 1) \
        .write.parquet(path)
    rows = spark.read.schema(T.StructType([df.schema[key], T.StructField("_part", T.IntegerType()),
                                           T.StructField("_no", T.LongType())])).parquet(path)
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    return rows.join(offsets, "_part").select(key, (F.col("_no") + F.col("_before")).alias("_no")), total


def gen_transactions(ids: DataFrame, customers: DataFrame, start: str = "2024-01-01",
                     end: str = "2024-01-31", id_col: str = "id", seed: int = 0, key: str = CUST_KEY) -> DataFrame:
    """One transaction per id over [start, end]: uniform day, second, amount 10.00-5000.00, type and
    product, and an account drawn uniformly from the saved ``customers`` (null when there are none)."""
    n_days = (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + 1
    i = F.col(id_col).cast("long")
    accounts, n = numbered(customers, key)
    seconds = draw(seed, "day", i, n_days) * 86400 + draw(seed, "second", i, 86400)
    ts = F.timestamp_add("SECOND", seconds, F.lit(start).cast("timestamp_ntz"))
    low, high = AMOUNT_CENTS
    cents = draw(seed, "amount", i, high - low + 1) + low
    tipo = F.when(draw(seed, "type", i, 2) == 0, "DEBITO").otherwise("CREDITO")
    prod = draw(seed, "product", i, 3)
    produto = F.when(prod == 0, "PIX").when(prod == 1, "TED").otherwise("CARTAO")
    out = ids.select(stable_uuid(F.concat(F.lit("t"), i.cast("string"))).alias("codigo_lancamento"),
                     draw(seed, "account", i, max(n, 1)).alias("_no"),
                     (cents.cast("double") / F.lit(100.0)).alias("valor_total_transacao"),
                     ts.alias("data_completa_transacao"), tipo.alias("tipo_transacao"),
                     produto.alias("tipo_produto_transacao"))
    out = out.join(accounts.withColumnRenamed(key, "numero_unico_conta"), "_no", "left")
    return out.select("codigo_lancamento", "numero_unico_conta", "valor_total_transacao", "data_completa_transacao",
                      "tipo_transacao", "tipo_produto_transacao", *partition_keys("data_completa_transacao"))
