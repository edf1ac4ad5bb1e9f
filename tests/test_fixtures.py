"""Hand-written edge cases (FIXTURES.md section 5), one tiny input each."""

import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import quality as Q
from ledgerline.operators import sinks as K
from ledgerline.operators.documents import SchemaMismatch, enforce, to_bulk_ndjson, to_document
from ledgerline.operators.enrich import enrich
from ledgerline.operators.monitor import evaluate_alarm
from ledgerline.plans.job import run_day
from ledgerline.schemas import CUST_RAW, ENR, PARTITION_COLS, TXN, TXN_RAW
from ledgerline.session import path_exists
from ledgerline.sources import json_files as J
from ledgerline.sources.customers import load_customers
from ledgerline.sources.inventory import file_inventory

import pytest

CUST_ROWS = [("A", "Ana Silva", "1990-05-01T00:00:00Z", "12345-678", "2023-01-01"),
             ("B", "Bruno Lima", "1985-01-01T12:00:00.123Z", "22222-000", "2022-02-02"),
             ("C", "Caio Reis", "garbage", "33333-000", "2021-01-01"),       # bad birth date
             ("D", "Dora Luz", "1970-01-01T00:00:00Z", None, "2020-01-01")]  # attribute absent


def customers(spark):
    valid, _ = load_customers(spark.createDataFrame(CUST_ROWS, CUST_RAW))
    return valid


def line(i, acct, amount=10.5, ts="2024-01-15T10:00:00Z", tipo="DEBITO", prod="PIX"):
    d = {"codigo_lancamento": i, "numero_unico_conta": acct, "valor_total_transacao": amount,
         "data_completa_transacao": ts, "tipo_transacao": tipo, "tipo_produto_transacao": prod}
    return json.dumps({k: v for k, v in d.items() if v is not None})


def write_day(spark, base, lines, day="15", month="01", year="2024"):
    path = f"{base}/year={year}/month={month}/day={day}"
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)
    return base


def txn(spark, rows):
    return spark.createDataFrame(rows, "codigo_lancamento string, numero_unico_conta string, "
                                       "valor_total_transacao double, data_completa_transacao timestamp_ntz, "
                                       "tipo_transacao string, tipo_produto_transacao string, "
                                       "year string, month string, day string")


T15 = dt.datetime(2024, 1, 15, 10, 0, 0)


def test_matched_unmatched_null_and_shared_accounts(spark):
    rows = [("1", "A", 1.0, T15, "DEBITO", "PIX", "2024", "01", "15"),
            ("2", "Z", 2.0, T15, "DEBITO", "PIX", "2024", "01", "15"),     # unmatched
            ("3", None, 3.0, T15, "DEBITO", "PIX", "2024", "01", "15"),    # null account
            ("4", "A", 4.0, T15, "CREDITO", "TED", "2024", "01", "15"),    # shared account
            ("5", "A", 5.0, T15, "CREDITO", "TED", "2024", "01", "15")]
    docs = {r["codigoLancamento"]: r for r in to_document(enrich(txn(spark, rows), customers(spark))).collect()}
    assert len(docs) == 5
    assert docs["1"]["nomeTitularConta"] == "Ana Silva" and docs["1"]["zipCode"] == "12345-678"
    assert docs["1"]["dataNascimentoTitularConta"] == dt.datetime(1990, 5, 1)
    assert docs["2"]["nomeTitularConta"] is None and docs["2"]["zipCode"] is None
    assert docs["3"]["nomeTitularConta"] is None and docs["3"]["valorTotalTransacao"] == 3.0
    assert {docs[k]["nomeTitularConta"] for k in ("1", "4", "5")} == {"Ana Silva"}


def test_bad_customer_rejected_and_its_transactions_unmatched(spark):
    valid, rejected = load_customers(spark.createDataFrame(CUST_ROWS, CUST_RAW))
    assert sorted(r[0] for r in valid.select("numero_unico_conta").collect()) == ["A", "B"]
    reasons = dict(rejected.select("numero_unico_conta", "reason").collect())
    assert reasons == {"C": "birth_date", "D": "missing:zip-code"}
    # fractional instant parsed to the millisecond, in UTC
    b = valid.where("numero_unico_conta = 'B'").first()["data_nascimento_titular_conta"]
    assert b == dt.datetime(1985, 1, 1, 12, 0, 0, 123000)
    rows = [("9", "C", 1.0, T15, "DEBITO", "PIX", "2024", "01", "15")]
    assert to_document(enrich(txn(spark, rows), valid)).first()["nomeTitularConta"] is None


def test_duplicate_id_latest_wins_and_rerun_is_identical(spark, tmp_base):
    rows = [("1", "A", 10.0, T15, "DEBITO", "PIX", "2024", "01", "15"),
            ("1", "A", 20.0, T15 + dt.timedelta(seconds=5), "DEBITO", "PIX", "2024", "01", "15"),
            ("2", "B", 30.0, T15, "DEBITO", "PIX", "2024", "01", "15")]
    docs = to_document(enrich(txn(spark, rows), customers(spark)), keep=PARTITION_COLS)
    order = ["dataCompletaTransacao", "valorTotalTransacao"]
    K.upsert(spark, tmp_base, docs, order_by=order)
    first = sorted(map(tuple, K.read_table(spark, tmp_base).collect()))
    K.upsert(spark, tmp_base, docs, order_by=order)
    second = sorted(map(tuple, K.read_table(spark, tmp_base).collect()))
    assert first == second
    got = dict(K.read_table(spark, tmp_base).select("codigoLancamento", "valorTotalTransacao").collect())
    assert got == {"1": 20.0, "2": 30.0}


def test_moved_day_rewrites_old_partition(spark, tmp_base):
    a = [("1", "A", 10.0, T15, "DEBITO", "PIX", "2024", "01", "15"),
         ("2", "A", 11.0, T15, "DEBITO", "PIX", "2024", "01", "15"),
         ("3", "A", 12.0, T15 - dt.timedelta(days=1), "DEBITO", "PIX", "2024", "01", "14")]
    K.upsert(spark, tmp_base, txn(spark, a), key="codigo_lancamento")
    t16 = T15 + dt.timedelta(days=1)
    b = [("1", "A", 10.0, t16, "DEBITO", "PIX", "2024", "01", "16"),      # moved 15 -> 16
         ("3", "A", 12.0, t16, "DEBITO", "PIX", "2024", "01", "16")]      # moved 14 -> 16, 14 now empty
    K.upsert(spark, tmp_base, txn(spark, b), key="codigo_lancamento")
    out = K.read_table(spark, tmp_base, txn(spark, b).schema)
    got = sorted((r["codigo_lancamento"], r["day"]) for r in out.collect())
    assert got == [("1", "16"), ("2", "15"), ("3", "16")]
    assert K.compact(spark, tmp_base) and not K.compact(spark, tmp_base)
    got = sorted((r["codigo_lancamento"], r["day"]) for r in K.read_table(spark, tmp_base, txn(spark, b).schema).collect())
    assert got == [("1", "16"), ("2", "15"), ("3", "16")]
    assert not any("day=14" in f for f in K.read_table(spark, tmp_base).inputFiles())


def test_quarantine_reasons_and_integer_amount(spark, tmp_base):
    write_day(spark, tmp_base, [line("1", "A"), line("2", "A", ts="garbage"), line("3", "A", amount=None),
                                '{"codigo', line("5", "A", amount=10)])
    good, bad = J.scan_with_quarantine(spark, tmp_base)
    assert sorted(r[0] for r in bad.select("reason").collect()) == ["amount", "json", "timestamp"]
    g = {r["codigo_lancamento"]: r for r in good.collect()}
    assert set(g) == {"1", "5"} and g["5"]["valor_total_transacao"] == 10.0
    assert g["1"]["data_completa_transacao"] == T15 and g["1"]["day"] == "15"


def test_array_file_multiline_vs_line_mode(spark, tmp_base):
    items = [dict(zip(CUST_RAW.fieldNames(), r)) for r in CUST_ROWS]
    path = f"{tmp_base}/array"
    spark.createDataFrame([(json.dumps(items, indent=2),)], "value string").coalesce(1).write.text(path)
    assert J.scan_array(spark, path, CUST_RAW).count() == 4
    schema = T.StructType(CUST_RAW.fields + [T.StructField("_corrupt_record", T.StringType())])
    line_mode = spark.read.schema(schema).json(path).cache()
    assert line_mode.where("_corrupt_record IS NULL AND numero_unico_conta IS NOT NULL").count() == 0


def test_json_array_writer_roundtrip(spark, tmp_base):
    df = spark.createDataFrame(CUST_ROWS, CUST_RAW)
    K.write_json_array(df, tmp_base, num_files=3)
    back = J.scan_array(spark, tmp_base, CUST_RAW)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_extra_column_union_keeps_enforce_drops(spark):
    old = spark.createDataFrame([("1", 1.0)], "codigo_lancamento string, valor_total_transacao double")
    new = spark.createDataFrame([("2", 2.0, "app")], "codigo_lancamento string, valor_total_transacao double, canal string")
    u = J.evolve_union(old, new)
    assert u.columns == ["codigo_lancamento", "valor_total_transacao", "canal"] and u.count() == 2
    src = spark.createDataFrame([("1", "a", 10, "2024-01-15 10:00:00", "DEBITO", "PIX", "x")],
                                "codigo_lancamento string, numero_unico_conta string, valor_total_transacao int, "
                                "data_completa_transacao string, tipo_transacao string, "
                                "tipo_produto_transacao string, extra string")
    out = enforce(src, TXN)
    assert out.columns == TXN.fieldNames() and out.first()["valor_total_transacao"] == 10.0
    with pytest.raises(SchemaMismatch):
        enforce(src.drop("tipo_transacao"), TXN)


def test_missing_day_is_empty_and_target_untouched(spark, tmp_base):
    base = write_day(spark, f"{tmp_base}/src", [line("1", "A")])
    target = f"{tmp_base}/target"
    assert J.scan_day(spark, base, "2024", "02", "01").count() == 0
    report = run_day(spark, base, "2024", "02", "01", customers(spark), target)
    assert report["status"] == "empty" and not path_exists(spark, target)
    report = run_day(spark, base, "2024", "01", "15", customers(spark), target)
    assert report["status"] == "succeeded" and report["rows_written"] == 1 and report["rows_matched"] == 1
    assert K.read_table(spark, target).count() == 1


def test_run_day_quarantines_and_counts(spark, tmp_base):
    base = write_day(spark, f"{tmp_base}/src", [line("1", "A"), line("2", "Z"), line("3", "A", ts="bad"),
                                                '{"codigo'])
    report = run_day(spark, base, "2024", "01", "15", customers(spark), f"{tmp_base}/t", f"{tmp_base}/q")
    assert (report["rows_read"], report["rows_written"], report["rows_matched"],
            report["rows_quarantined"]) == (4, 2, 1, 2)


def test_out_of_domain_listed(spark):
    rows = [("1", "A", 1.0, T15, "DEBITO", "DOC", "2024", "01", "15"),
            ("2", "A", 1.0, T15, "DEBITO", "PIX", "2024", "01", "15")]
    out = Q.check_domain(txn(spark, rows), "tipo_produto_transacao", ("PIX", "TED", "CARTAO")).collect()
    assert [(r["value"], r["n_rows"]) for r in out] == [("DOC", 1)]


def test_zone_stays_on_day_with_non_utc_session(spark, tmp_base):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        from ledgerline.session import configure
        configure(spark)                       # the library pins UTC again
        write_day(spark, tmp_base, [line("1", "A", ts="2024-01-15T23:59:59Z")])
        r = J.scan_tree(spark, tmp_base).first()
        assert r["data_completa_transacao"] == dt.datetime(2024, 1, 15, 23, 59, 59)
        assert (r["year"], r["month"], r["day"]) == ("2024", "01", "15")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_missing_metric_bucket_breaks_the_run(spark):
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    pts = [("m", base, 20.0), ("m", base + dt.timedelta(seconds=600), 20.0),       # breach, gap, breach
           ("n", base, 20.0), ("n", base + dt.timedelta(seconds=300), 20.0)]       # two adjacent breaches
    s = spark.createDataFrame(pts, "metric string, ts timestamp_ntz, value double")
    alarms = lambda metric: [r["bucket_start"] for r in evaluate_alarm(s, "r", metric, "sum", 300, ">", 10.0, 2).collect()]
    assert alarms("m") == [] and alarms("n") == [base + dt.timedelta(seconds=300)] and alarms("other") == []


def test_partitioned_writer_zero_pads(spark, tmp_base):
    rows = [("1", "A", 1.0, dt.datetime(2024, 3, 5, 1, 2, 3), "DEBITO", "PIX", "2024", "03", "05")]
    K.write_partitioned_jsonl(txn(spark, rows), tmp_base)
    assert path_exists(spark, f"{tmp_base}/year=2024/month=03/day=05")
    back = J.scan_day(spark, tmp_base, "2024", "03", "05").first()
    assert back["data_completa_transacao"] == dt.datetime(2024, 3, 5, 1, 2, 3)


def test_bulk_ndjson_explicit_nulls_and_epoch_millis(spark, tmp_base):
    rows = [("x\"1", "Z", 1.5, T15, "DEBITO", "PIX", "2024", "01", "15")]
    docs = to_document(enrich(txn(spark, rows), customers(spark)))
    lines = [r["line"] for r in to_bulk_ndjson(docs, "idx").orderBy("line_no").collect()]
    action, doc = json.loads(lines[0]), json.loads(lines[1])
    assert action == {"index": {"_index": "idx", "_id": "x\"1"}}
    assert doc["nomeTitularConta"] is None and "zipCode" in doc
    assert doc["dataCompletaTransacao"] == int(T15.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert list(doc) == ENR.fieldNames()


def test_assign_batches_bounded(spark):
    rows = [(str(i), "A", 1.0, T15, "DEBITO", "PIX", "2024", "01", "15") for i in range(250)]
    docs = to_document(txn(spark, rows).withColumn("nome_titular_conta", F.lit(None).cast("string"))
                       .withColumn("data_nascimento_titular_conta", F.lit(None).cast("timestamp_ntz"))
                       .withColumn("zip_code", F.lit(None).cast("string")), keep=PARTITION_COLS)
    b = K.assign_batches(docs, size=40, buckets=2).collect()
    assert sum(r["n_docs"] for r in b) == 250 and max(r["n_docs"] for r in b) <= 40


def test_bulk_body_files_and_iso_dates(spark, tmp_base):
    from ledgerline.operators.documents import write_bulk_ndjson
    rows = [(str(i), "A", 1.0 + i, T15, "DEBITO", "PIX", "2024", "01", "15") for i in range(5)]
    docs = to_document(enrich(txn(spark, rows), customers(spark)))
    write_bulk_ndjson(docs.repartition(2), tmp_base, "transactions", date_format="iso")
    lines = [r[0] for r in spark.read.text(tmp_base).collect()]
    assert len(lines) == 10
    for i in range(0, len(lines), 2):                   # action immediately followed by its document
        action, doc = json.loads(lines[i]), json.loads(lines[i + 1])
        assert action["index"]["_id"] == doc["codigoLancamento"]
        assert doc["dataCompletaTransacao"] == "2024-01-15T10:00:00.000Z"
        assert doc["dataNascimentoTitularConta"] == "1990-05-01T00:00:00.000Z"


def test_record_run_appends_reports(spark, tmp_base):
    from ledgerline.operators.monitor import record_run
    t0 = dt.datetime(2024, 1, 16, 2, 0, tzinfo=dt.timezone.utc)
    record_run(spark, tmp_base, {"year": "2024", "month": "01", "day": "15", "status": "succeeded",
                                 "rows_read": 3, "rows_written": 2, "seconds": 1.5, "started_on": t0,
                                 "completed_on": t0 + dt.timedelta(seconds=1.5)})
    record_run(spark, tmp_base, {"year": "2024", "month": "01", "day": "16", "status": "empty"})
    got = sorted((r["run_id"], r["state"], r["rows_written"]) for r in spark.read.parquet(tmp_base).collect())
    assert got == [("jr_20240115", "succeeded", 2), ("jr_20240116", "empty", 0)]
    first = spark.read.parquet(tmp_base).where("run_id = 'jr_20240115'").first()
    assert first["started_on"] == dt.datetime(2024, 1, 16, 2, 0) and first["run_date"] == "2024-01-15"


def test_document_moved_far_back_leaves_one_copy(spark, tmp_base):
    a = [("1", "A", 10.0, T15, "DEBITO", "PIX", "2024", "01", "15"),
         ("2", "A", 11.0, T15, "DEBITO", "PIX", "2023", "12", "26")]
    K.upsert(spark, tmp_base, txn(spark, a), key="codigo_lancamento")
    b = [("2", "A", 11.0, T15, "DEBITO", "PIX", "2024", "01", "15")]              # 20 days later
    stats = K.upsert(spark, tmp_base, txn(spark, b), key="codigo_lancamento")
    got = sorted((r["codigo_lancamento"], r["day"]) for r in K.read_table(spark, tmp_base, txn(spark, b).schema).collect())
    assert got == [("1", "15"), ("2", "15")] and stats["touched_partitions"] == 1
    assert K.compact(spark, tmp_base) and not any("day=26" in f for f in K.read_table(spark, tmp_base).inputFiles())


def test_failed_write_fails_the_job(spark, tmp_base):
    base = write_day(spark, f"{tmp_base}/src", [line("1", "A")])
    blocker = f"{tmp_base}/target"
    spark.createDataFrame([("x",)], "v string").coalesce(1).write.text(blocker)
    a_file = [f for f in spark.read.text(blocker).inputFiles()][0]       # a file where the target should be
    with pytest.raises(Exception):
        run_day(spark, base, "2024", "01", "15", customers(spark), a_file)


def test_approximate_distinct_accounts_close_to_exact(spark):
    from ledgerline.operators.enrich import distinct_accounts
    rows = [(str(i), f"acct{i % 700}", 1.0, T15, "DEBITO", "PIX", "2024", "01", "15") for i in range(3000)]
    df = txn(spark, rows)
    exact = distinct_accounts(df).first()["distinct_accounts"]
    approx = distinct_accounts(df, approx_rsd=0.02).first()["distinct_accounts"]
    assert exact == 700 and abs(approx - exact) <= 0.06 * exact


def test_metric_stats_time_range(spark):
    from ledgerline.operators.monitor import metric_stats
    base = dt.datetime(2024, 1, 1)
    pts = [("m", base + dt.timedelta(seconds=60 * i), float(i)) for i in range(30)]
    s = spark.createDataFrame(pts, "metric string, ts timestamp_ntz, value double")
    out = metric_stats(s, 300, "2024-01-01 00:05:00", "2024-01-01 00:15:00").orderBy("bucket_start").collect()
    assert [(r["n_points"], r["sum_value"], r["min_value"], r["max_value"]) for r in out] == \
        [(5, 35.0, 5.0, 9.0), (5, 60.0, 10.0, 14.0)]


def test_repeated_dimension_key_never_duplicates_transactions(spark):
    dup = CUST_ROWS[:2] + [("A", "Ana Souza", "1990-05-01T00:00:00Z", "99999-000", "2024-01-01")]
    valid, _ = load_customers(spark.createDataFrame(dup, CUST_RAW))
    rows = [("1", "A", 1.0, T15, "DEBITO", "PIX", "2024", "01", "15")]
    out = to_document(enrich(txn(spark, rows), valid, dedupe_dim_by="data_criacao_registro")).collect()
    assert len(out) == 1 and out[0]["nomeTitularConta"] == "Ana Souza" and out[0]["zipCode"] == "99999-000"


def test_bucketed_customer_load_rewrites_only_touched_buckets(spark, tmp_base):
    valid = customers(spark)
    K.upsert_bucketed(spark, tmp_base, valid, key="numero_unico_conta", buckets=16)
    stats = K.upsert_bucketed(spark, tmp_base, valid.where("numero_unico_conta = 'A'")
                              .withColumn("nome_titular_conta", F.lit("Ana Nova")), key="numero_unico_conta",
                              buckets=16)
    assert stats["touched_partitions"] == 1
    got = dict(K.read_bucketed(spark, tmp_base, valid.schema).select("numero_unico_conta", "nome_titular_conta")
               .collect())
    assert got == {"A": "Ana Nova", "B": "Bruno Lima"}


def test_cluster_settings_scale_with_input():
    from ledgerline.session import cluster_settings
    small, big = cluster_settings(10 * 2**30), cluster_settings(100 * 2**40)
    assert int(small["spark.sql.shuffle.partitions"]) == 8000          # two waves of 4000 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 * 2**20)
    assert big["spark.sql.optimizer.runtime.bloomFilter.enabled"] == "true"


@pytest.mark.parametrize("size", [1, 3, 5, 10])
def test_match_all_page_sizes(spark, size):
    from ledgerline.operators.search import search
    rows = [(f"{i:02d}", "A", float(i), T15, "DEBITO", "PIX", "2024", "01", "15") for i in range(12)]
    docs = to_document(enrich(txn(spark, rows), customers(spark)))
    got = [r["codigoLancamento"] for r in search(docs, size=size).collect()]
    assert got == [f"{i:02d}" for i in range(size)]


def test_failing_send_fails_the_write(spark):
    from ledgerline.operators.lookup_udf import write_with

    def send(pdf):
        raise ConnectionError("bulk endpoint down")
    with pytest.raises(Exception):
        write_with(spark.range(10), send)


def upserted(spark, target, cols):
    return sorted((tuple(r) for r in K.read_table(spark, target).select(*cols).collect()), key=str)


def test_null_and_special_partition_values_leave_the_rest_alone(spark, tmp_base):
    month = [(str(i), "A", 1.0, T15, "DEBITO", "PIX", "2024", "01", f"{i + 1:02d}") for i in range(10)]
    K.upsert(spark, tmp_base, txn(spark, month), key="codigo_lancamento")
    odd = [("x", "A", 1.0, T15, "DEBITO", "PIX", "2024", "01", None), ("y", "A", 1.0, T15, "DEBITO", "PIX", None, None, None),
           ("z", "A", 1.0, T15, "DEBITO", "PIX", "2024", "01", "a/b:c%d"), ("e", "A", 1.0, T15, "DEBITO", "PIX", "2024", "01", "")]
    for _ in range(2):
        K.upsert(spark, tmp_base, txn(spark, odd), key="codigo_lancamento")
    got = upserted(spark, tmp_base, ["codigo_lancamento", "year", "month", "day"])
    want = [(r[0], r[6], r[7], r[8] or None) for r in [*month, *odd]]
    assert got == sorted(want, key=str)
    back = [("z", "A", 1.0, T15, "DEBITO", "PIX", "2024", "01", "01"), ("y", "A", 1.0, T15, "DEBITO", "PIX", "2024", "01", "01")]
    K.upsert(spark, tmp_base, txn(spark, back), key="codigo_lancamento")          # both emptied partitions go
    got = upserted(spark, tmp_base, ["codigo_lancamento", "day"])
    assert ("z", "01") in got and ("y", "01") in got and len(got) == 14
    first = f"{tmp_base}-first"
    K.upsert(spark, first, txn(spark, odd[:2]), key="codigo_lancamento")          # null days on a first load
    assert len(upserted(spark, first, ["codigo_lancamento"])) == 2


def test_null_keys_are_idempotent_and_stored_columns_stay(spark, tmp_base):
    rows = [(None, "A", 1.0, T15, "DEBITO", "PIX", "2024", "01", "15"), (None, "B", 2.0, T15, "DEBITO", "PIX", "2024", "01", "15"),
            ("1", "C", 3.0, T15, "DEBITO", "PIX", "2024", "01", "15")]
    first = txn(spark, rows).withColumn("canal", F.lit("app"))
    K.upsert(spark, tmp_base, first, key="codigo_lancamento")
    K.upsert(spark, tmp_base, first, key="codigo_lancamento")
    assert len(upserted(spark, tmp_base, ["numero_unico_conta"])) == 3
    new = txn(spark, [("2", "D", 4.0, T15, "DEBITO", "PIX", "2024", "01", "15")])  # lacks ``canal``
    K.upsert(spark, tmp_base, new.withColumn("loja", F.lit(7)), key="codigo_lancamento")
    got = upserted(spark, tmp_base, ["codigo_lancamento", "canal", "loja"])
    assert sorted(got, key=str) == sorted([(None, "app", None), (None, "app", None), ("1", "app", None), ("2", None, 7)], key=str)


def _row(i, v, day):
    return (i, "A", v, T15, "DEBITO", "PIX", "2024", "01", day)


def test_a_failure_before_the_note_leaves_the_table(spark, tmp_base, monkeypatch):
    from ledgerline.operators import upsert as U
    K.upsert(spark, tmp_base, txn(spark, [_row("1", 1.0, "01"), _row("2", 2.0, "02"), _row("3", 3.0, "03")]), key="codigo_lancamento")
    change = txn(spark, [_row("1", 10.0, "02"), _row("3", 30.0, "03")])
    cols = ["codigo_lancamento", "valor_total_transacao", "day"]

    def broken(*a):
        raise OSError("lost")
    for step, call in (("_commit", K.upsert), ("write_text", K.upsert)):
        monkeypatch.setattr(U, step, broken)
        with pytest.raises(OSError):
            call(spark, tmp_base, change, key="codigo_lancamento")
        monkeypatch.undo()
        assert upserted(spark, tmp_base, cols) == [("1", 1.0, "01"), ("2", 2.0, "02"), ("3", 3.0, "03")]
    with pytest.raises(U.ConcurrentWriter):                               # the second failure left its claim
        K.upsert(spark, tmp_base, change, key="codigo_lancamento")
    monkeypatch.setattr(U, "LEASE_SECONDS", -1)                           # ... which is dead after the lease
    K.upsert(spark, tmp_base, change, key="codigo_lancamento")
    assert upserted(spark, tmp_base, cols) == [("1", 10.0, "02"), ("2", 2.0, "02"), ("3", 30.0, "03")]
    assert K.recover(spark, tmp_base) and not K.recover(spark, tmp_base)  # folders of the failed writers go
    assert upserted(spark, tmp_base, cols) == [("1", 10.0, "02"), ("2", 2.0, "02"), ("3", 30.0, "03")]


def test_two_writers_one_is_refused(spark, tmp_base, monkeypatch):
    from ledgerline.operators import upsert as U
    K.upsert(spark, tmp_base, txn(spark, [_row("1", 1.0, "01")]), key="codigo_lancamento")
    real = U._commit

    def late(session, target, snap):                                      # the other writer commits first
        monkeypatch.setattr(U, "_commit", real)
        K.upsert(session, target, txn(session, [_row("2", 2.0, "02")]), key="codigo_lancamento")
        real(session, target, snap)
    monkeypatch.setattr(U, "_commit", late)
    with pytest.raises(U.ConcurrentWriter):
        K.upsert(spark, tmp_base, txn(spark, [_row("3", 3.0, "03")]), key="codigo_lancamento")
    assert upserted(spark, tmp_base, ["codigo_lancamento"]) == [("1",), ("2",)]


def test_a_lost_note_loses_one_commit_only(spark, tmp_base):
    """Twelve keys, one per partition: without the newest note the table is as it was before that commit."""
    from ledgerline.operators import upsert as U
    twelve = [_row(str(i), 1.0, f"{i + 1:02d}") for i in range(12)]
    K.upsert(spark, tmp_base, txn(spark, twelve), key="codigo_lancamento")
    K.upsert(spark, tmp_base, txn(spark, [_row(str(i), 2.0, f"{i + 1:02d}") for i in range(6)]), key="codigo_lancamento")
    U.delete_path(spark, f"{tmp_base}/_log/{U.snapshot(spark, tmp_base).version:08d}.json")
    assert len(upserted(spark, tmp_base, ["codigo_lancamento"])) == 12
    for name, _ in U.list_folder(spark, f"{tmp_base}/_log"):
        if name.endswith(".claim"):
            U.delete_path(spark, f"{tmp_base}/_log/{name}")
    for _ in range(2):
        K.upsert(spark, tmp_base, txn(spark, [_row(str(i), 3.0, f"{i + 2:02d}") for i in range(12)]), key="codigo_lancamento")
        assert upserted(spark, tmp_base, ["valor_total_transacao"]) == [(3.0,)] * 12
    U.delete_path(spark, f"{tmp_base}/_log")
    with pytest.raises(ValueError, match="log"):
        K.upsert(spark, tmp_base, txn(spark, twelve), key="codigo_lancamento")


def test_an_upsert_writes_its_own_rows_and_opens_no_stored_file(spark, tmp_base):
    from ledgerline.operators import upsert as U
    rows = [_row(str(i), 1.0, f"{i % 28 + 1:02d}") for i in range(280)]
    K.upsert(spark, tmp_base, txn(spark, rows), key="codigo_lancamento")
    before = set(K.read_table(spark, tmp_base).inputFiles())
    K.upsert(spark, tmp_base, txn(spark, [_row("1", 5.0, "02"), _row("x", 6.0, "03")]), key="codigo_lancamento")
    snap = U.snapshot(spark, tmp_base)
    new = U._folders(spark, tmp_base, snap.deltas, snap.fields)
    assert new.count() == 2 and before <= set(K.read_table(spark, tmp_base).inputFiles()) and len(snap.base) == 28
    assert K.compact(spark, tmp_base)
    after = set(K.read_table(spark, tmp_base).inputFiles())
    kept = {f.split("day=")[1][:2] for f in before & after}
    assert kept == {f"{d:02d}" for d in range(1, 29)} - {"02", "03"}       # only the two days were rewritten
    assert K.read_table(spark, tmp_base).count() == 281


def test_compaction_opens_only_files_that_may_hold_its_keys(spark, tmp_base):
    from ledgerline.operators import upsert as U
    rows = [_row(f"k{i}", 1.0, f"{i % 28 + 1:02d}") for i in range(2800)]
    K.upsert(spark, tmp_base, txn(spark, rows), key="codigo_lancamento", partition_cols=PARTITION_COLS, cluster_by_partition=True)
    snap = U.snapshot(spark, tmp_base)
    moved = txn(spark, [_row("k0", 2.0, "28"), _row("k1", 2.0, "28")])
    opened = {f.split("day=")[1][:2] for f in U.files_with(spark, tmp_base, snap, moved)}
    assert {"01", "02"} <= opened and len(opened) <= 5                    # 28 files, 1 % false positives each
    hashes = moved.select(F.xxhash64("codigo_lancamento")).toPandas().iloc[:, 0].to_numpy().view("uint64")
    assert U.may_hold(U.bloom_filter(hashes), hashes[:1])


def test_upserts_equal_a_plain_dictionary(spark, tmp_base):
    """Batches with moves, repeats, deletions and compactions against a dictionary."""
    import random
    rng, want = random.Random(4), {}
    for n in range(7):
        batch = [_row(str(rng.randrange(40)), float(n * 100 + k), f"{rng.randrange(1, 6):02d}") for k in range(12)]
        K.upsert(spark, tmp_base, txn(spark, batch), key="codigo_lancamento", order_by=["valor_total_transacao"], compact_after=3)
        for r in batch:
            want[r[0]] = (r[0], r[2], r[8])
        if n in (2, 5):
            gone = [str(k) for k in range(n, 40, 7)]
            K.delete_keys(spark, tmp_base, spark.createDataFrame([(k,) for k in gone], "codigo_lancamento string"))
            want = {k: v for k, v in want.items() if k not in gone}
        assert upserted(spark, tmp_base, ["codigo_lancamento", "valor_total_transacao", "day"]) == sorted(want.values(), key=str)
    K.compact(spark, tmp_base)
    assert upserted(spark, tmp_base, ["codigo_lancamento", "valor_total_transacao", "day"]) == sorted(want.values(), key=str)


def test_only_new_partitions_are_registered(spark, tmp_base):
    import uuid
    base = write_day(spark, f"{tmp_base}/src", [line("1", "A"), line("2", "A")])
    write_day(spark, base, [line("3", "A", ts="2024-01-16T10:00:00Z"), line("2", "A", ts="2024-01-16T10:00:00Z")], day="16")
    target, name = f"{tmp_base}/docs", f"docs_{uuid.uuid4().hex[:8]}"
    for day in ("15", "16"):
        run_day(spark, base, "2024", "01", day, customers(spark), target, table=name)
        stored = sorted(map(tuple, spark.table(name).select("codigoLancamento", "day").collect()))
        assert stored == sorted(map(tuple, K.read_table(spark, target).select("codigoLancamento", "day").collect()))
    assert stored == [("1", "15"), ("2", "16"), ("3", "16")]
    assert K.drop_table(spark, name) and not path_exists(spark, f"{target}/data")


def test_streams_account_for_every_row(spark, tmp_base):
    from ledgerline.streaming import ingest as ST
    lines = {"20": [line("1", "A", ts="2024-01-20T10:00:00Z"), '{"codigo', '{"cod'], "05": [line("2", "A", ts="2024-01-05T10:00:00Z")],
             "06": [line("1", "A", ts="2024-01-20T10:00:00Z"), line(None, "A", ts="2024-01-06T10:00:00Z")]}
    for day, own in lines.items():
        write_day(spark, f"{tmp_base}/src", own, day=day)
    base, cust = f"{tmp_base}/src", customers(spark)
    ST.stream_ingest(spark, base, f"{tmp_base}/t1", f"{tmp_base}/c1", cust, f"{tmp_base}/q1", max_files_per_trigger=1)
    assert len(upserted(spark, f"{tmp_base}/t1", ["codigoLancamento"])) == 2
    bad = lambda p: sorted(r[0] for r in spark.read.schema("reason string").option("recursiveFileLookup", "true").json(p).collect())
    assert bad(f"{tmp_base}/q1") == ["id", "json", "json"]
    ST.stream_enrich(spark, base, f"{tmp_base}/t2", f"{tmp_base}/c2", cust, f"{tmp_base}/q2", max_files_per_trigger=1)
    assert spark.read.parquet(f"{tmp_base}/t2").where("codigoLancamento is null").count() == 0 and bad(f"{tmp_base}/q2") == ["id", "json", "json"]
    ST.stream_dedupe_into(spark, base, f"{tmp_base}/t3", f"{tmp_base}/c3", f"{tmp_base}/q3", f"{tmp_base}/late", max_files_per_trigger=1)
    ids = lambda p: [r[0] for r in spark.read.option("recursiveFileLookup", "true").parquet(p).select("codigo_lancamento").collect()]
    assert set(ids(f"{tmp_base}/t3")) | set(ids(f"{tmp_base}/late")) == {"1", "2"} and len(bad(f"{tmp_base}/q3")) == 3
    ST.stream_tumbling(spark, base, f"{tmp_base}/t4", f"{tmp_base}/c4", f"{tmp_base}/q4", max_files_per_trigger=1)
    assert ST.window_totals(spark, f"{tmp_base}/t4").agg(F.sum("n_transactions")).first()[0] == 3


def test_insert_new_counts_rows_without_a_key_and_never_repeats_them(spark, tmp_base):
    rows = [(None, "A", 1.0, T15, "DEBITO", "PIX", "2024", "01", "15"), ("1", "A", 1.0, T15, "DEBITO", "PIX", "2024", "01", "15")]
    got = [K.insert_new(spark, tmp_base, txn(spark, rows), key="codigo_lancamento") for _ in range(2)]
    assert got == [{"rows_added": 1, "rows_without_key": 1}, {"rows_added": 0, "rows_without_key": 1}]


@pytest.mark.parametrize("end", ["2024-01-07", "2024-01-28", "2024-01-31"])
def test_generators_use_every_value(spark, end):
    from ledgerline.operators.generate import gen_customers, gen_transactions
    cust = gen_customers(spark.range(31))
    out = gen_transactions(spark.range(4000), cust, end=end, seed=3)
    days, accounts, hours = out.agg(F.count_distinct("day"), F.count_distinct("numero_unico_conta"),
                                    F.count_distinct(F.hour("data_completa_transacao"))).first()
    assert (days, accounts, hours) == (int(end[-2:]), 31, 24)
    assert out.join(cust, "numero_unico_conta", "left_anti").count() == 0
    assert out.exceptAll(gen_transactions(spark.range(4000), cust, end=end, seed=3)).count() == 0


def test_generated_customers_have_exact_ages(spark):
    from ledgerline.operators.generate import gen_customers
    r = gen_customers(spark.range(20000)).selectExpr(
        "min(left(data_nascimento_titular_conta, 10)) lo", "max(left(data_nascimento_titular_conta, 10)) hi",
        "min(datediff('2024-01-31', data_criacao_registro)) a", "max(datediff('2024-01-31', data_criacao_registro)) b").first()
    assert r.lo >= "1944-01-31" and "2005-12-01" < r.hi <= "2006-01-31" and (r.a, r.b) == (1, 1825)


def test_inventory_counts_empty_files(spark, tmp_base):
    from ledgerline.session import touch
    write_day(spark, tmp_base, [line("1", "A")])
    touch(spark, f"{tmp_base}/year=2024/month=01/day=15/none.json")
    touch(spark, f"{tmp_base}/year=2024/month=01/day=16/none.json")
    touch(spark, f"{tmp_base}/year=2024/month=01/day=16/nested/more.json")
    touch(spark, f"{tmp_base}/year=2024/month=01/day=16/_hidden/no.json")
    got = sorted((r["day"], r["n_files"], r["n_bytes"] > 0) for r in file_inventory(spark, tmp_base).collect())
    assert got == [("15", 2, True), ("16", 2, False)]
    assert file_inventory(spark, f"{tmp_base}/year=2024").count() == 0                       # no partition below


def test_schema_check_reports_extra_fields(spark):
    df = spark.createDataFrame([("1", 2)], "codigoLancamento string, canal int")
    bad = {r["column_name"]: (r["expected_type"], r["actual_type"]) for r in Q.check_schema(df).collect() if not r["ok"]}
    assert bad["canal"] == ("", "int") and bad["zipCode"] == ("string", "") and "codigoLancamento" not in bad


def test_retention_prefix(spark, tmp_base):
    rows = [("1", "A", 1.0, T15, "DEBITO", "PIX", "2022", "01", "15"), ("2", "A", 1.0, T15, "DEBITO", "PIX", "2021", "01", "15")]
    df = txn(spark, rows)
    df.write.partitionBy(*PARTITION_COLS).parquet(tmp_base)
    assert K.expire(spark, tmp_base, "2024-01-31", prefix="year=2021/") == [("2021", "01", "15")]
    assert [r[0] for r in K.read_table(spark, tmp_base, df.schema).select("codigo_lancamento").collect()] == ["1"]


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    from ledgerline.session import shared_dir
    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=sc, conf=conf))


def test_days_in_one_pass_equal_days_one_by_one(spark, tmp_base):
    from ledgerline.plans.job import run_days
    base = f"{tmp_base}/src"
    for day, own in {"15": [line("1", "A"), line("1", "A"), "{bad"], "16": [line("2", "Z", ts="2024-01-16T10:00:00Z")], "17": ["{bad"]}.items():
        write_day(spark, base, own, day=day)
    days = [("2024", "01", d) for d in ("15", "16", "17", "18")]
    whole = run_days(spark, base, days, customers(spark), f"{tmp_base}/all")
    single = [run_day(spark, base, *d, customers(spark), f"{tmp_base}/each") for d in days]
    fields = ("day", "status", "rows_read", "rows_written", "rows_matched", "rows_quarantined")
    assert [[r[c] for c in fields] for r in whole] == [[r[c] for c in fields] for r in single]
    stored = lambda p: sorted(map(tuple, K.read_table(spark, f"{tmp_base}/{p}").collect()))
    assert stored("all") == stored("each") and abs(sum(r["seconds"] for r in whole)) > 0


def test_staged_writes_deliver_once(spark, tmp_base):
    from ledgerline.operators.lookup_udf import FolderSink, StagedWriter, write_staged
    from ledgerline.session import qualified
    uri = qualified(spark, tmp_base)
    rows = lambda: sorted(r[0] for r in spark.read.schema("id long").json(tmp_base).collect())
    write_staged(spark.range(2500).repartition(4), FolderSink(uri), size=300)
    assert rows() == list(range(2500))

    bad = spark.range(2500, 2600).repartition(2).select(F.expr("if(id = 2599, assert_true(false), null)").alias("x"), "id").select("id", "x")
    with pytest.raises(Exception):
        write_staged(bad, FolderSink(uri), size=10)                       # aborted: nothing of it is seen
    assert rows() == list(range(2500))

    sink = FolderSink(uri)
    writer, part = StagedWriter(sink, 2), [__import__("pyspark").sql.Row(id=n) for n in range(3000, 3005)]

    def fails():
        yield from part[:3]
        raise OSError("lost")
    with pytest.raises(OSError):
        writer.write(fails())                                              # an attempt that staged two rows
    writer.commit([writer.write(iter(part)), None])
    assert rows() == [*range(2500), *range(3000, 3005)] and sink.recover() == 0


def test_window_sums_survive_replays_and_read_only_their_dates(spark, tmp_base, monkeypatch):
    from ledgerline.operators import upsert as U
    from ledgerline.streaming import ingest as ST
    for n in range(4):
        write_day(spark, f"{tmp_base}/src", [line(f"{n}{k}", "A", 1.5, ts=f"2024-01-0{n + 1}T10:00:00Z") for k in range(3)], day=f"0{n + 1}")
    listed, real, fails = [], U._folders, {"at": 2}

    def folders(session, target, names, schema):
        listed.append([f for f in names if f.count("/")])
        return real(session, target, names, schema)
    upsert = ST.upsert

    def once(session, target, *a, **k):                                    # the third micro-batch fails after its upsert
        out = upsert(session, target, *a, **k)
        fails["at"] -= 1
        if fails["at"] == -1:
            raise OSError("lost")
        return out
    monkeypatch.setattr(ST, "upsert", once)
    monkeypatch.setattr(U, "_folders", folders)
    run = lambda: ST.stream_tumbling(spark, f"{tmp_base}/src", f"{tmp_base}/t", f"{tmp_base}/c", f"{tmp_base}/q", max_files_per_trigger=1)
    with pytest.raises(Exception):
        run()
    run()
    got = [(r.n_transactions, r.sum_valor) for r in ST.window_totals(spark, f"{tmp_base}/t").collect()]
    assert got == [(3, 4.5)] * 4
    assert max(map(len, listed)) <= 4


def test_rollup_follows_upserts_and_lost_writers(spark, tmp_base, monkeypatch):
    import random
    from ledgerline.operators import summaries as S
    rng, want = random.Random(3), {}
    target, rollup, by = f"{tmp_base}/docs", f"{tmp_base}/rollup", ["day", "tipo_transacao"]
    opts = {"by": by, "amount": "valor_total_transacao", "key": "codigo_lancamento", "order_by": ["valor_total_transacao"]}
    real = S.finish
    for n in range(5):
        rows = [(str(rng.randrange(25)), "A", float(n * 100 + k) + 0.25, T15, rng.choice(["DEBITO", "CREDITO"]), "PIX", "2024", "01",
                 f"{rng.randrange(1, 4):02d}") for k in range(10)]
        calls = []
        if n == 3:                                                         # the writer is lost after its commit

            def lost(*a):
                calls.append(a)
                if len(calls) == 2:
                    raise OSError("lost")
                return real(*a)
            monkeypatch.setattr(S, "finish", lost)
            with pytest.raises(OSError):
                S.upsert_with_rollup(spark, target, rollup, txn(spark, rows), compact_after=3, **opts)
            monkeypatch.undo()
        else:
            S.upsert_with_rollup(spark, target, rollup, txn(spark, rows), compact_after=3, **opts)
        for r in rows:
            want[r[0]] = r
        got = {(r.day, r.tipo_transacao): (r.n, float(r.cents)) for r in S.rolled_up(spark, target, rollup, by).collect()} if n != 3 else None
        if n != 3:
            full = {}
            for r in want.values():
                c, t = full.get((r[8], r[4]), (0, 0.0))
                full[r[8], r[4]] = (c + 1, t + r[2])
            assert got == full


def test_digests_name_only_what_differs(spark, tmp_base):
    from ledgerline.operators import summaries as S
    rows = [(str(k), "A", 1.0, T15, "DEBITO", "PIX", "2024", f"{k % 3 + 1:02d}", f"{k % 5 + 1:02d}") for k in range(60)]
    txn(spark, rows).write.partitionBy(*PARTITION_COLS).parquet(f"{tmp_base}/s")
    source, same = K.read_table(spark, f"{tmp_base}/s", txn(spark, rows).schema), txn(spark, rows[::-1])
    dig = lambda df: S.digests(df, "codigo_lancamento")
    assert S.differing(dig(source), dig(same)).count() == 0 and S.missing_by_digest(source, same, "codigo_lancamento").count() == 0
    swapped = txn(spark, [r if r[0] != "7" else ("77", *r[1:]) for r in rows])      # as many rows, one other id
    nodes = sorted((r.level, r.month, r.day, r.differing_below) for r in S.differing(dig(source), dig(swapped)).collect())
    assert nodes == [(0, None, None, 1), (1, None, None, 1), (2, "02", None, 1), (3, "02", "03", 1)]
    missing = S.missing_by_digest(source, swapped, "codigo_lancamento")
    assert [r[0] for r in missing.collect()] == ["7"]
    plan = missing._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "(month#" in plan and "<=> 02)" in plan


def test_sketches_over_ranges(spark, tmp_base):
    from ledgerline.operators import summaries as S
    rows = [(str(k), f"acct{(k * 7) % 900}" if k % 11 else None, 1.0, T15, "DEBITO", "PIX", "2024", "01", f"{k % 9 + 1:02d}") for k in range(4000)]
    S.store_sketches(txn(spark, rows), f"{tmp_base}/sk")
    day = lambda d: dt.date(2024, 1, d)
    asked = [(day(1), day(9)), (day(3), day(4)), (day(5), day(5)), (day(20), day(21))]
    got = {(r.start, r.stop): r.distinct_keys for r in S.distinct_over(spark, f"{tmp_base}/sk", spark.createDataFrame(asked, "start date, stop date")).collect()}
    for a, b in asked[:3]:
        exact = len({r[1] for r in rows if r[1] and a.day <= int(r[8]) <= b.day})
        assert abs(got[a, b] - exact) <= 0.03 * exact
    assert asked[3] not in got


def test_alarm_transitions_over_restarts(spark, tmp_base):
    """Micro-batches, a restart between them, a period without points and a late point."""
    from ledgerline.streaming import alarms as A
    rules = {"high": ("m", "avg", 60, ">", 10.0, 2), "any": ("m", "max", 60, ">=", 50.0, 1)}
    t0 = dt.datetime(2024, 1, 1)
    point = lambda minute, v, metric="m": (metric, t0 + dt.timedelta(minutes=minute, seconds=5), float(v))
    parts = [[point(0, 20), point(1, 20), point(1, 2), point(2, 30)], [point(3, 60), point(5, 70), point(6, 11), point(4, 1, "other")],
             [point(2, 1), point(7, 1), point(9, 90), point(30, 0, "clock")]]
    out, stream = f"{tmp_base}/out", f"{tmp_base}/points"
    for own in parts:
        spark.createDataFrame(own, "metric string, ts timestamp_ntz, value double").coalesce(1).write.mode("append").parquet(stream)
        source = spark.readStream.schema("metric string, ts timestamp_ntz, value double").parquet(stream)
        A.stream_alarms(spark, source, out, f"{tmp_base}/c", rules, delay="1 minute")
    got = sorted((r.rule, (r.bucket_start - t0).seconds // 60, r.state) for r in A.transitions(spark, out).collect())
    assert got == [("any", 3, "ALARM"), ("any", 4, "OK"), ("any", 5, "ALARM"), ("any", 6, "OK"), ("any", 9, "ALARM"), ("any", 10, "OK"),
                   ("high", 1, "ALARM"), ("high", 4, "OK"), ("high", 6, "ALARM"), ("high", 7, "OK")]
