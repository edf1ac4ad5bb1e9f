"""The whole workflow through the command line: generate, load customers, run a day, check."""

from ledgerline.cli import main


def test_workflow(spark, tmp_base):
    cust, txns, table = f"{tmp_base}/customers", f"{tmp_base}/transactions", f"{tmp_base}/customer_table"
    target = f"{tmp_base}/documents"
    main(["generate", "--customers", "25", "--transactions", "1200", "--customers-out", cust,
          "--transactions-out", txns], spark)
    loaded = main(["load-customers", "--items", cust, "--array", "--table", table], spark)
    assert loaded == {"loaded": 25, "expected": 25, "actual": 25, "ok": True}
    rep = main(["run-day", "--base", txns, "--year", "2024", "--month", "01", "--day", "15",
                "--customers", table, "--target", target], spark)
    assert rep["status"] == "succeeded" and rep["rows_written"] == rep["rows_read"] > 0
    assert rep["rows_matched"] == rep["rows_written"]          # every generated account exists
    again = main(["run-day", "--base", txns, "--year", "2024", "--month", "01", "--day", "15",
                  "--customers", table, "--target", target, "--ledger", f"{tmp_base}/ledger"], spark)
    assert spark.read.parquet(f"{tmp_base}/ledger").count() == 1
    out = main(["check", "--target", target], spark)
    assert out["documents"] == rep["rows_written"] == again["rows_written"]     # rerun: no duplicates
    assert {b["tipoTransacao"] for b in out["by_type"]} <= {"DEBITO", "CREDITO"}
    assert out["total_value"].startswith("R$ ")
    empty = main(["run-day", "--base", txns, "--year", "2024", "--month", "02", "--day", "01",
                  "--customers", table, "--target", target], spark)
    assert empty["status"] == "empty"
    checked = main(["check", "--target", target, "--ledger", f"{tmp_base}/ledger"], spark)
    assert checked["last_run"]["state"] == "succeeded" and checked["last_run"]["rows_written"] == rep["rows_written"]
    counts = main(["reconcile", "--base", txns, "--target", target, "--missing", f"{tmp_base}/missing"], spark)
    assert counts["source_rows"] == 1200 and counts["indexed_docs"] == rep["rows_written"]
    assert spark.read.json(f"{tmp_base}/missing").count() == counts["missing_docs"] == 1200 - rep["rows_written"]
    main(["ndjson", "--target", target, "--out", f"{tmp_base}/bulk"], spark)
    assert spark.read.text(f"{tmp_base}/bulk").count() == 2 * rep["rows_written"]
    assert main(["expire", "--target", target, "--as-of", "2025-06-01", "--prefix", "year=2023/"], spark) == {"removed": []}
    assert main(["expire", "--target", target, "--as-of", "2025-06-01"], spark) == {"removed": ["year=2024/month=01/day=15"]}
    assert main(["drop", "--target", target], spark) == {"existed": True}
    assert main(["drop", "--target", target], spark) == {"existed": False}


def test_alarms_and_catalog_table(spark, tmp_base):
    import datetime as dt
    points = [("ClusterStatus.red", dt.datetime(2024, 1, 1), 1.0), ("CPUUtilization", dt.datetime(2024, 1, 1), 99.0)]
    spark.createDataFrame(points, "metric string, ts timestamp_ntz, value double").write.parquet(f"{tmp_base}/metrics")
    assert main(["alarms", "--metrics", f"{tmp_base}/metrics", "--out", f"{tmp_base}/alarms"], spark) == {"alarms": 1}
    main(["generate", "--customers", "5", "--transactions", "90", "--end", "2024-01-02", "--customers-out", f"{tmp_base}/c",
          "--transactions-out", f"{tmp_base}/t"], spark)
    main(["load-customers", "--items", f"{tmp_base}/c", "--array", "--table", f"{tmp_base}/ct"], spark)
    n = 0
    for day in ("01", "02"):
        n += main(["run-day", "--base", f"{tmp_base}/t", "--year", "2024", "--month", "01", "--day", day, "--customers",
                   f"{tmp_base}/ct", "--target", f"{tmp_base}/docs", "--table", "cli_docs"], spark)["rows_written"]
    assert spark.table("cli_docs").count() == n == 90
    main(["drop", "--target", f"{tmp_base}/docs", "--table", "cli_docs"], spark)
    assert not spark.catalog.tableExists("cli_docs")
