"""A key holding a third of all rows: results stay whole, the plan splits or pre-aggregates it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.documents import to_document
from ledgerline.operators.enrich import enrich, lookup
from ledgerline.operators.sinks import latest_per_key
from ledgerline.schemas import CUST

N = 30_000
SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def facts(spark):
    ids = spark.range(N)
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
    return ids.select(F.col("id").cast("string").alias("codigo_lancamento"), hot.alias("numero_unico_conta"),
                      (F.col("id") % 1000 / 10.0).alias("valor_total_transacao"),
                      F.lit(dt.datetime(2024, 1, 15)).cast("timestamp_ntz").alias("data_completa_transacao"),
                      F.lit("DEBITO").alias("tipo_transacao"), F.lit("PIX").alias("tipo_produto_transacao"))


def dim(spark):
    keys = spark.range(500).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k")).union(
        spark.createDataFrame([("hot",)], "k string"))
    return keys.select(F.col("k").alias("numero_unico_conta"), F.concat(F.lit("Name "), "k").alias("nome_titular_conta"),
                       F.lit(dt.datetime(1990, 1, 1)).cast("timestamp_ntz").alias("data_nascimento_titular_conta"),
                       F.lit("00000-000").alias("zip_code"), F.lit("2020-01-01").alias("data_criacao_registro")) \
        .select(*CUST.fieldNames())


def test_hot_account_enrichment_is_whole_and_split(spark, skew_conf):
    docs = to_document(enrich(facts(spark), dim(spark)))
    got = docs.agg(F.count(F.lit(1)).alias("n"), F.count("nomeTitularConta").alias("m"),
                   F.count_if(F.col("numeroUnicoConta") == "hot").alias("hot")).first()
    assert (got["n"], got["m"], got["hot"]) == (N, N, N // 3)
    docs.collect()                                   # run this DataFrame's own adaptive plan
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan
    assert "skew=true" in plan                      # AQE split the hot account's partition


def test_hot_key_dedupe_is_limited_before_the_shuffle(spark, skew_conf):
    df = facts(spark).withColumnRenamed("codigo_lancamento", "seq")
    out = latest_per_key(df, "numero_unico_conta", ["valor_total_transacao", "seq"])
    rows = {r["numero_unico_conta"]: r for r in out.collect()}
    assert len(rows) == 501 and rows["hot"]["valor_total_transacao"] == 99.9
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_hot_key_semi_lookup(spark, skew_conf):
    got = lookup(dim(spark), facts(spark)).count()
    assert got == 501


def test_salted_enrichment_equals_plain(spark, skew_conf):
    plain = to_document(enrich(facts(spark), dim(spark)))
    salted = to_document(enrich(facts(spark), dim(spark), salt_buckets=8))
    a = sorted(map(tuple, plain.collect()), key=str)
    b = sorted(map(tuple, salted.collect()), key=str)
    assert a == b and len(b) == N
    p = salted._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in p


def test_salted_stream_enrich(spark, tmp_base):
    from ledgerline.operators import sinks as K
    from ledgerline.session import scratch_path
    from ledgerline.streaming.ingest import stream_enrich
    from ledgerline.sources.json_files import scan_tree
    rows = facts(spark).limit(2000).withColumn("year", F.lit("2024")).withColumn("month", F.lit("01")) \
        .withColumn("day", F.lit("15"))
    K.write_partitioned_jsonl(rows, f"{tmp_base}/src")
    stream_enrich(spark, f"{tmp_base}/src", f"{tmp_base}/out", scratch_path(spark, "ckpt"), dim(spark),
                  f"{tmp_base}/bad")
    out = spark.read.parquet(f"{tmp_base}/out")
    assert out.count() == 2000 and out.where("nomeTitularConta IS NULL").count() == 0


def test_insert_new_collapses_hot_copies_and_is_replay_safe(spark, tmp_base):
    from ledgerline.operators.sinks import insert_new, read_table
    base = facts(spark).withColumn("year", F.lit("2024")).withColumn("month", F.lit("01")) \
        .withColumn("day", F.lit("15"))
    hot_copies = base.where("codigo_lancamento = '0'").select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(N // 2))).alias("_copy")).drop("_copy")
    batch = base.unionByName(hot_copies)                 # id '0' holds a third of the rows
    r1 = insert_new(spark, tmp_base, batch, key="codigo_lancamento")
    r2 = insert_new(spark, tmp_base, batch, key="codigo_lancamento")   # replay / redelivery
    out = read_table(spark, tmp_base, base.schema)
    assert (r1["rows_added"], r2["rows_added"], out.count()) == (N, 0, N)
    assert out.where("codigo_lancamento = '0'").count() == 1
