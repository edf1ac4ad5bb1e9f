"""Command line for the daily workflow (spark-submit friendly).

  generate        customers (JSON array files) and date-partitioned transactions (JSON Lines)
  load-customers  parse customer items, upsert them by key, verify the loaded count
  run-day         the daily job for one year/month/day
  stream          the same transform over every new file (available-now or every 900 s)
  check           post-run verification: count, one sample, type/product buckets, sum, average, last run
  expire          delete date partitions past their retention
  drop            delete a target
  reconcile       source rows against stored documents, missing ids
  alarms          evaluate the alarm rules over a metric table
  ndjson          stored documents as bulk request bodies

Paths may be any Hadoop URI; scratch and checkpoints default to ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F

from ledgerline.operators import sinks as K
from ledgerline.operators.documents import write_bulk_ndjson
from ledgerline.operators.generate import gen_customers, gen_transactions
from ledgerline.operators.monitor import evaluate_rules, latest_run
from ledgerline.operators.quality import missing_ids, reconcile, verify_count
from ledgerline.operators.search import stats
from ledgerline.operators.upsert import DIMENSION_BUCKETS
from ledgerline.plans.job import run_day
from ledgerline.schemas import CUST, CUST_RAW, DEFAULT_SEARCH_SIZE, DOCS_SCHEMA, ENR_COLS, PARTITION_COLS
from ledgerline.session import build_session, configure, path_exists, scratch_path
from ledgerline.sources.customers import load_customers
from ledgerline.sources.json_files import scan_array, scan_tree


def _customers(spark, path):
    return K.read_bucketed(spark, path, CUST)


def cmd_generate(spark, a):
    K.write_json_array(gen_customers(spark.range(a.customers), seed=a.seed), a.customers_out)
    saved = scan_array(spark, a.customers_out, CUST_RAW)
    txn = gen_transactions(spark.range(a.transactions), saved, a.start, a.end, seed=a.seed)
    K.write_partitioned_jsonl(txn, a.transactions_out, files_per_partition=a.files_per_partition)
    return {"customers": a.customers, "transactions": a.transactions}


def cmd_load_customers(spark, a):
    items = scan_array(spark, a.items, CUST_RAW) if a.array else spark.read.schema(CUST_RAW).json(a.items)
    valid, rejected = load_customers(items)
    if a.rejected:
        rejected.write.mode("overwrite").json(a.rejected)
    stats = K.upsert_bucketed(spark, a.table, valid, key="numero_unico_conta", buckets=a.buckets)
    check = verify_count(_customers(spark, a.table), items).first()
    return {"loaded": stats["rows_from_batch"], "expected": check["expected"], "actual": check["actual"],
            "ok": check["ok"]}


def cmd_run_day(spark, a):
    report = run_day(spark, a.base, a.year, a.month, a.day, _customers(spark, a.customers), a.target,
                     a.quarantine, a.table)
    if a.ledger:
        from ledgerline.operators.monitor import record_run
        record_run(spark, a.ledger, report)
    return report


def cmd_stream(spark, a):
    from ledgerline.streaming.ingest import stream_ingest
    q = stream_ingest(spark, a.base, a.target, a.checkpoint or scratch_path(spark, "stream-ckpt"),
                      _customers(spark, a.customers), a.quarantine or f"{a.target.rstrip('/')}_quarantine",
                      available_now=not a.continuous)
    if a.continuous:
        q.awaitTermination()
    return {"status": "done"}


def cmd_check(spark, a):
    """Everything the verification asks of the stored documents from one grouping-sets scan, one sample,
    and the last run's state where a ledger is given."""
    docs = K.read_table(spark, a.target, DOCS_SCHEMA)
    rows = stats(docs).collect()     # a row per type, per product and one for all
    total = next((r for r in rows if r["grouping_id"] == 3), None)
    sample = docs.select(*ENR_COLS).orderBy("codigoLancamento").limit(1).collect()
    buckets = lambda gid, c: [{c: r[c], "doc_count": r["doc_count"]} for r in sorted(
        (r for r in rows if r["grouping_id"] == gid and r[c] is not None), key=lambda r: (-r["doc_count"], r[c]))][:DEFAULT_SEARCH_SIZE]
    out = {"documents": total["doc_count"] if total else 0,
           "sample": sample[0].asDict() if sample else None,
           "total_value": f"R$ {total['sum_valor'] if total else 0:,.2f}",
           "average_value": round((total["avg_valor"] if total else None) or 0.0, 2),
           "by_type": buckets(1, "tipoTransacao"), "by_product": buckets(2, "tipoProdutoTransacao")}
    if a.ledger:
        last = latest_run(spark.read.parquet(a.ledger)).collect()
        out["last_run"] = last[0].asDict() if last else None
    return out


def cmd_expire(spark, a):
    removed = K.expire(spark, a.target, a.as_of, prefix=a.prefix)
    return {"removed": ["/".join(f"{c}={v}" for c, v in zip(PARTITION_COLS, r)) for r in removed]}


def cmd_drop(spark, a):
    existed = path_exists(spark, a.target)
    if a.table:
        K.drop_table(spark, a.table)
    K.drop_target(spark, a.target)
    return {"existed": existed}


def cmd_reconcile(spark, a):
    target = K.read_table(spark, a.target, DOCS_SCHEMA).withColumnRenamed("codigoLancamento", "codigo_lancamento")
    source = scan_tree(spark, a.base)
    if a.missing:
        missing_ids(source, target, "codigo_lancamento").write.mode("overwrite").json(a.missing)
    counts = reconcile(source, target, "codigo_lancamento").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("source_rows", "indexed_docs", "missing_docs")])
    return counts.first().asDict()


def cmd_alarms(spark, a):
    """Alarms of the rules over a metric table (metric, ts, value), written as JSON; how many there are."""
    points = spark.read.schema("metric string, ts timestamp_ntz, value double").parquet(a.metrics)
    evaluate_rules(points).write.mode("overwrite").json(a.out)
    return {"alarms": spark.read.schema("rule string").json(a.out).count()}


def cmd_ndjson(spark, a):
    write_bulk_ndjson(K.read_table(spark, a.target, DOCS_SCHEMA).select(*ENR_COLS), a.out, a.index)
    return {"status": "done"}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="ledgerline")
    p.add_argument("--master", default=None, help="only for local runs; spark-submit sets it")
    sub = p.add_subparsers(dest="cmd", required=True)
    g = sub.add_parser("generate")
    g.add_argument("--customers", type=int, default=25)
    g.add_argument("--transactions", type=int, default=1200)
    g.add_argument("--start", default="2024-01-01")
    g.add_argument("--end", default="2024-01-31")
    g.add_argument("--customers-out", required=True)
    g.add_argument("--transactions-out", required=True)
    g.add_argument("--files-per-partition", default=None)
    g.add_argument("--seed", type=int, default=0)
    lc = sub.add_parser("load-customers")
    lc.add_argument("--items", required=True)
    lc.add_argument("--array", action="store_true", help="items are JSON array files")
    lc.add_argument("--table", required=True)
    lc.add_argument("--rejected", default=None)
    lc.add_argument("--buckets", type=int, default=DIMENSION_BUCKETS, help="hash partitions of the customer table")
    rd = sub.add_parser("run-day")
    for name in ("--base", "--year", "--month", "--day", "--customers", "--target"):
        rd.add_argument(name, required=True)
    rd.add_argument("--quarantine", default=None)
    rd.add_argument("--ledger", default=None, help="append the run report to this run-ledger table")
    rd.add_argument("--table", default=None, help="catalog name of the target; created if absent")
    st = sub.add_parser("stream")
    for name in ("--base", "--customers", "--target"):
        st.add_argument(name, required=True)
    st.add_argument("--checkpoint", default=None)
    st.add_argument("--quarantine", default=None)
    st.add_argument("--continuous", action="store_true", help="trigger every 900 s instead of available-now")
    ck = sub.add_parser("check")
    ck.add_argument("--target", required=True)
    ck.add_argument("--ledger", default=None, help="also report the last run of this run-ledger table")
    ex = sub.add_parser("expire")
    ex.add_argument("--target", required=True)
    ex.add_argument("--as-of", required=True)
    ex.add_argument("--prefix", default="", help="only partitions whose path starts so, e.g. year=2023/")
    dr = sub.add_parser("drop")
    dr.add_argument("--target", required=True)
    dr.add_argument("--table", default=None)
    rc = sub.add_parser("reconcile")
    rc.add_argument("--base", required=True)
    rc.add_argument("--target", required=True)
    rc.add_argument("--missing", default=None, help="write the missing ids here")
    al = sub.add_parser("alarms")
    al.add_argument("--metrics", required=True)
    al.add_argument("--out", required=True)
    nd = sub.add_parser("ndjson")
    nd.add_argument("--target", required=True)
    nd.add_argument("--out", required=True)
    nd.add_argument("--index", default="transactions")
    return p


COMMANDS = {"generate": cmd_generate, "load-customers": cmd_load_customers, "run-day": cmd_run_day,
            "stream": cmd_stream, "check": cmd_check, "expire": cmd_expire, "drop": cmd_drop,
            "reconcile": cmd_reconcile, "alarms": cmd_alarms, "ndjson": cmd_ndjson}


def main(argv=None, spark=None) -> dict:
    a = parser().parse_args(argv)
    if getattr(a, "files_per_partition", None) not in (None, "range"):
        a.files_per_partition = int(a.files_per_partition)
    if spark is None:
        spark = build_session(a.master) if a.master else configure(
            __import__("pyspark.sql", fromlist=["SparkSession"]).SparkSession.builder.getOrCreate())
    result = COMMANDS[a.cmd](spark, a)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
