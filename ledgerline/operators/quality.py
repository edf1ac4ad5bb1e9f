"""Data quality and reconciliation.

Every check is an aggregate: one scan per input, partial aggregation in each
task, a handful of result rows.  Reports are stacked with ``stack`` rather
than unions of separate scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import (CUST_KEY, DOC_KEY, ENR, PARTITION_COLS, PRODUCT_TYPES,
                                TRANSACTION_TYPES)


def check_domains(df: DataFrame, allowed: dict[str, tuple]) -> DataFrame:
    """P10: per column, values outside its allowed set (nulls included) with counts; one scan."""
    bad = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"),
                    (~F.coalesce(F.col(c).isin(list(v)), F.lit(False))).alias("bad")) for c, v in allowed.items()]
    return (df.select(F.inline(F.array(*bad))).where("bad").groupBy("column_name", "value")
            .agg(F.count(F.lit(1)).alias("n_rows")))


def check_domain(df: DataFrame, column: str, allowed) -> DataFrame:
    """P10 for one column."""
    return check_domains(df, {column: allowed})


def check_volume(txn: DataFrame, min_rows: int = 1000, min_accounts: int = 20,
                 key: str = CUST_KEY) -> DataFrame:
    """Q1: enough transactions and distinct accounts."""
    return txn.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_accounts")).select(
        "n_rows", "n_accounts", F.lit(min_rows).alias("min_rows"), F.lit(min_accounts).alias("min_accounts"),
        ((F.col("n_rows") >= min_rows) & (F.col("n_accounts") >= min_accounts)).alias("ok"))


def check_layout(txn: DataFrame, ts: str = "data_completa_transacao") -> DataFrame:
    """Q2: the event date must equal the partition it is stored in."""
    mismatch = ((F.date_format(ts, "yyyy") != F.col("year")) | (F.date_format(ts, "MM") != F.col("month"))
                | (F.date_format(ts, "dd") != F.col("day")))
    return txn.groupBy(*PARTITION_COLS).agg(F.count(F.lit(1)).alias("n_rows"),
                                            F.count_if(F.coalesce(mismatch, F.lit(True))).alias("n_mismatch"))


def check_schema(df: DataFrame, expected: T.StructType = ENR) -> DataFrame:
    """Q3: per field, expected or found, its types and its non-null count (one scan).  ``ok`` is false
    for a missing field (empty actual type), another type, and a field nobody expects (empty expected
    type)."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    names = [*wanted, *[n for n in actual if n not in wanted]]
    counts = df.agg(*[(F.count(F.col(f"`{n}`")) if n in actual else F.lit(0).cast("long")).alias(n) for n in names])
    rows = [F.struct(F.lit(n).alias("column_name"), F.lit(wanted.get(n, "")).alias("expected_type"),
                     F.lit(actual.get(n, "")).alias("actual_type"), F.lit(wanted.get(n) == actual.get(n)).alias("ok"),
                     F.col(f"`{n}`").alias("n_non_null")) for n in names]
    return counts.select(F.inline(F.array(*rows)))


def profile(df: DataFrame, key: str = DOC_KEY) -> DataFrame:
    """Q4: key uniqueness and null count of every column, one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_distinct_ids"),
                  *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{c}") for c in df.columns])


_OPS = {">=": lambda v, t: v >= t, "<=": lambda v, t: v <= t, "==": lambda v, t: v == t}


def dq_report(docs: DataFrame, rejected_customers: DataFrame, min_rows: int = 1000,
              min_accounts: int = 20) -> DataFrame:
    """Q5: one table of (check, value, threshold, status) from two aggregates.

    ``status`` is ``pass`` / ``fail`` for checks with a threshold and ``info``
    for counts reported without a verdict.
    """
    tipo_bad = ~F.coalesce(F.col("tipoTransacao").isin(list(TRANSACTION_TYPES)), F.lit(False))
    prod_bad = ~F.coalesce(F.col("tipoProdutoTransacao").isin(list(PRODUCT_TYPES)), F.lit(False))
    plain = [  # name, aggregate, comparison, threshold: one scan with partial aggregation
        ("volume_rows", F.count(F.lit(1)), ">=", float(min_rows)),
        ("null_ids", F.count_if(F.col(DOC_KEY).isNull()), "==", 0.0),
        ("tipo_out_of_domain", F.count_if(tipo_bad), "==", 0.0),
        ("produto_out_of_domain", F.count_if(prod_bad), "==", 0.0),
        ("unmatched_documents", F.count_if(F.col("nomeTitularConta").isNull()), None, None),
    ]

    def row(name, value, op, thr):   # informational checks carry no threshold / verdict
        status = (F.when(_OPS[op](value, F.lit(thr)), "pass").otherwise("fail") if op else F.lit("info"))
        return F.struct(F.lit(name).alias("check_name"), value.cast("double").alias("value"),
                        F.lit(thr).cast("double").alias("threshold"), status.alias("status"))

    def rows(df: DataFrame, checks) -> DataFrame:
        wide = df.agg(*[agg.alias(name) for name, agg, _, _ in checks])
        return wide.select(F.inline(F.array(*[row(n, F.col(n), op, thr) for n, _, op, thr in checks])))

    # distinct counts group their one column first: rows are not expanded per distinct column
    accounts = docs.groupBy("numeroUnicoConta").agg(F.lit(1).alias("_one"))
    ids = docs.groupBy(DOC_KEY).agg(F.count(F.lit(1)).alias("_n"))
    extra = F.when(F.col(DOC_KEY).isNull(), F.col("_n")).otherwise(F.col("_n") - 1)
    return (rows(docs, plain)
            .unionByName(rows(accounts, [("distinct_accounts", F.count("numeroUnicoConta"), ">=", float(min_accounts))]))
            .unionByName(rows(ids, [("duplicate_ids", F.coalesce(F.sum(extra), F.lit(0)), "==", 0.0)]))
            .unionByName(rows(rejected_customers, [("customers_rejected", F.count(F.lit(1)), None, None)])))


def reconcile(source: DataFrame, target: DataFrame, key: str, by=PARTITION_COLS) -> DataFrame:
    """R1 counts: per source group, rows, rows present in the target, rows missing."""
    hits = target.select(key).distinct().withColumn("_hit", F.lit(True))
    joined = source.select(key, *by).join(hits, key, "left")
    return joined.groupBy(*by).agg(F.count(F.lit(1)).alias("source_rows"),
                                   F.count("_hit").alias("indexed_docs"),
                                   F.count_if(F.col("_hit").isNull()).alias("missing_docs"))


def missing_ids(source: DataFrame, target: DataFrame, key: str, keep=PARTITION_COLS) -> DataFrame:
    """R1 listing: source ids absent from the target (anti join)."""
    return source.select(key, *keep).join(target.select(key), key, "left_anti")


def verify_count(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Loaded rows vs expected rows; ok when actual >= expected (one combined aggregate)."""
    both = (actual.select(F.lit(1).alias("_a"), F.lit(0).alias("_e"))
            .unionByName(expected.select(F.lit(0).alias("_a"), F.lit(1).alias("_e"))))
    return both.agg(F.coalesce(F.sum("_e"), F.lit(0)).cast("long").alias("expected"),
                    F.coalesce(F.sum("_a"), F.lit(0)).cast("long").alias("actual")) \
        .select("expected", "actual", (F.col("actual") >= F.col("expected")).alias("ok"))
