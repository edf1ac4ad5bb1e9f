"""Physical-plan shape: pushdown, pruning, join strategy, no Python on the default path."""

from ledgerline.plans import registry
from ledgerline.plans.q_files import jsonl_tree
from ledgerline.sources import json_files as J
from tests.conftest import SF_SMALL

Q = registry.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted") \
        if hasattr(df._sc._jvm, "PythonSQLUtils") else plan(df)


def test_day_filter_reaches_parquet_scan(spark):
    p = formatted(Q["enrich_left_join"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in p and "LessThan(ts,2024-01-16T00:00)" in p
    assert "BroadcastHashJoin" in p and "LeftOuter" in p


def test_projection_prunes_columns(spark):
    p = formatted(Q["source_fields"](spark, SF_SMALL))
    assert "ReadSchema: struct<codigoLancamento:string,valorTotalTransacao:double,tipoTransacao:string>" in p


STORED = ("count_docs match_all term_filter term_total source_fields text_match range_filter terms_tipo terms_produto "
          "sum_valor avg_valor stats_grouping_sets domain_violations dq_nulls_and_keys bulk_batches").split()


def test_search_and_analytics_read_stored_documents_without_a_join(spark):
    for name in STORED:
        p = plan(Q[name](spark, SF_SMALL))
        assert "Join" not in p and "docs-stored" in formatted(Q[name](spark, SF_SMALL)), name


def test_day_scan_lists_only_its_directory(spark):
    base = jsonl_tree(spark, SF_SMALL)
    df = J.scan_day(spark, base, "2024", "01", "15")
    files = df.inputFiles()                      # the relation itself only knows day 15's files
    assert files and all("/year=2024/month=01/day=15/" in f for f in files)
    r = df.select("year", "month", "day").distinct().collect()
    assert [tuple(x) for x in r] == [("2024", "01", "15")]
    rng = J.scan_range(spark, base, "2024-01-10", "2024-01-12")
    assert {f.split("day=")[1][:2] for f in rng.inputFiles()} == {"10", "11", "12"}
    assert J.scan_day(spark, base, "2024", "02", "30").count() == 0


def test_tree_filter_prunes_partitions(spark):
    base = jsonl_tree(spark, SF_SMALL)
    p = formatted(J.read_jsonl(spark, base).where(J.day_predicate("2024", "01", "15")))
    assert "PartitionFilters" in p and "= 2024)" in p


def test_no_python_on_default_path(spark):
    for name in ("enrich_left_join", "stats_grouping_sets", "upsert_dedupe", "metric_stats",
                 "alarm_sum_2of2", "bulk_ndjson", "terms_tipo", "dq_report"):
        p = plan(Q[name](spark, SF_SMALL))
        assert "Python" not in p and "ArrowEval" not in p, name


def test_latest_per_key_scans_once_and_limits_before_the_shuffle(spark):
    import re
    for name, scans in (("upsert_dedupe", 1), ("union_last_wins", 3)):
        p = formatted(Q[name](spark, SF_SMALL))
        assert len(re.findall(r"\(\d+\) Scan parquet", p)) == scans and "Partial" in p and "WindowGroupLimit" in p, name


def test_grouping_sets_single_scan(spark):
    p = formatted(Q["stats_grouping_sets"](spark, SF_SMALL))
    import re
    assert len(re.findall(r"\(\d+\) Scan parquet", p)) == 1 and "Expand" in p


def test_batched_lookup_is_arrow_batched(spark):
    p = plan(Q["batched_lookup_udf"](spark, SF_SMALL))
    assert "MapInPandas" in p or "MapInArrow" in p
