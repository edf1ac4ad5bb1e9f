"""Properties: enrichment keeps rows, upsert idempotence, J1 = B1, stream = batch."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators import sinks as K
from ledgerline.operators.documents import to_document
from ledgerline.operators.enrich import DIM_COLS, enrich
from ledgerline.operators.lookup_udf import batched_lookup
from ledgerline.schemas import CUST, PARTITION_COLS
from ledgerline.session import scratch_path
from ledgerline.streaming import ingest as ST
from ledgerline.sources.json_files import parse_raw, scan_tree
from tests.test_fixtures import txn

import pandas as pd
from pyspark.sql import types as T

BASE = dt.datetime(2024, 1, 1)
accounts = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d", "e"]))
rows_st = st.lists(st.tuples(st.integers(0, 30), accounts, st.integers(0, 5000), st.integers(0, 2)),
                   min_size=0, max_size=25)


def make_txn(spark, rows):
    out = []
    for i, (k, acct, cents, d) in enumerate(rows):
        ts = BASE + dt.timedelta(days=d, seconds=cents)
        out.append((str(k), acct, cents / 100.0, ts, "DEBITO", "PIX", "2024", "01", f"{d + 1:02d}"))
    return txn(spark, out)


def dim(spark):
    rows = [(a, f"Name {a}", dt.datetime(1990, 1, 1), f"0000{i}-000", "2023-01-01") for i, a in enumerate("abc")]
    return spark.createDataFrame(rows, CUST)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_st)
def test_enrichment_keeps_rows_and_ids(spark, rows):
    df = make_txn(spark, rows)
    out = to_document(enrich(df, dim(spark))).collect()
    assert sorted(r["codigoLancamento"] for r in out) == sorted(str(r[0]) for r in rows)
    for r in out:
        assert (r["nomeTitularConta"] is not None) == (r["numeroUnicoConta"] in ("a", "b", "c"))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_st.filter(lambda r: len(r) > 0))
def test_upsert_idempotent_and_unique(spark, rows):
    target = scratch_path(spark, "prop-upsert")
    batch = make_txn(spark, rows)
    K.upsert(spark, target, batch, key="codigo_lancamento", order_by=["data_completa_transacao"])
    once = sorted(map(tuple, K.read_table(spark, target, batch.schema).collect()), key=str)
    K.upsert(spark, target, batch, key="codigo_lancamento", order_by=["data_completa_transacao"])
    twice = sorted(map(tuple, K.read_table(spark, target, batch.schema).collect()), key=str)
    assert once == twice
    assert len(once) == len({r[0] for r in rows})


def test_join_equals_batched_lookup(spark):
    rows = [(i, "abcdz"[i % 5] if i % 7 else None, i * 13, i % 3) for i in range(60)]
    df = make_txn(spark, rows).drop(*PARTITION_COLS)
    d = dim(spark)
    store = scratch_path(spark, "prop-store")
    d.write.parquet(store)

    class Fetch:
        def __call__(self, keys):
            import pyarrow.parquet as pq
            path = store[len("file:"):] if store.startswith("file:") else store
            t = pq.read_table(path).to_pandas()
            return t[t["numero_unico_conta"].isin(keys)][["numero_unico_conta", *DIM_COLS]]

    schema = T.StructType([f for f in CUST.fields if f.name in ("numero_unico_conta", *DIM_COLS)])
    via_udf = to_document(batched_lookup(df, Fetch(), "numero_unico_conta", schema, chunk=7, batch=2))
    via_join = to_document(enrich(df, d))
    assert sorted(map(tuple, via_udf.collect()), key=str) == sorted(map(tuple, via_join.collect()), key=str)


def test_write_with_counts_every_row(spark):
    from ledgerline.operators.lookup_udf import write_with
    df = spark.range(2500).repartition(3)
    assert write_with(df, lambda pdf: len(pdf), size=1000) == 2500


def test_stream_equals_batch(spark):
    rows = [(i, "abc"[i % 3], i * 17, i % 4) for i in range(40)]
    df = make_txn(spark, rows)
    base = scratch_path(spark, "prop-stream-src")
    K.write_partitioned_jsonl(df, base)
    target = scratch_path(spark, "prop-stream-target")
    ST.stream_ingest(spark, base, target, scratch_path(spark, "prop-ckpt"), dim(spark),
                     scratch_path(spark, "prop-bad"), max_files_per_trigger=2)
    streamed = sorted(map(tuple, K.read_table(spark, target).drop(*PARTITION_COLS).collect()), key=str)
    batch = sorted(map(tuple, to_document(enrich(scan_tree(spark, base), dim(spark))).collect()), key=str)
    assert streamed == batch


def test_stream_archives_processed_files(spark):
    import glob
    rows = [(i, "abc"[i % 3], i * 17, i % 4) for i in range(12)]
    base = scratch_path(spark, "prop-archive-src")
    K.write_partitioned_jsonl(make_txn(spark, rows), base)
    archive, target = scratch_path(spark, "prop-archive"), scratch_path(spark, "prop-archive-target")
    ST.stream_ingest(spark, base, target, scratch_path(spark, "prop-ckpt"), dim(spark),
                     scratch_path(spark, "prop-bad"), archive_dir=archive, max_files_per_trigger=4)
    assert K.read_table(spark, target).count() == 12
    local = lambda p: p[len("file:"):] if p.startswith("file:") else p
    # files of a batch are archived when the next batch commits: all but the last batch's
    assert len(glob.glob(local(archive) + "/**/*.txt", recursive=True)) >= 4
