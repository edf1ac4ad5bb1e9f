"""Every registered query equals its DuckDB oracle on sf0.001 (rows-only when no oracle)."""

import pytest

from ledgerline.plans import registry
from tests.conftest import SF_SMALL
from tests.oracle import compare

registry.queries()
NAMES = sorted(registry.REGISTRY)


def test_registry_covers_survey_plan():
    expected = """enrich_left_join enriched_documents keyed_lookup unmatched_anti_join enrichment_rate
    referential_check unenriched_filter count_docs match_all term_filter term_total source_fields text_match
    range_filter terms_tipo terms_produto sum_valor avg_valor stats_grouping_sets share_by_type share_by_product
    totals currency_format day_scan date_range_scan tree_partition_counts partitioned_write_roundtrip
    json_array_scan schema_evolution_union enforce_schema camelize_columns customer_parse quarantine_reasons
    empty_day table_sample partition_key_name epoch_and_iso file_inventory upsert_dedupe upsert_rerun
    customer_upsert union_last_wins bulk_ndjson bulk_batches write_metrics index_readback
    ensure_table_idempotent drop_table retention_tiers retention_expire reconcile_counts reconcile_missing
    verify_count distinct_accounts_per_day lookup_plan domain_violations dq_volume dq_partition_layout dq_schema
    dq_nulls_and_keys dq_report metric_stats alarm_sum_2of2 alarm_avg_3of3 alarm_min alarm_max log_scan
    run_ledger latest_run run_cost gen_customers gen_transactions stream_ingest stream_enrich stream_dedupe
    stream_tumbling batched_lookup_udf""".split()
    assert not set(expected) - set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    fn, sql = registry.REGISTRY[name]
    info = compare(spark, duck, name, fn, sql, SF_SMALL, pandas_check=True)
    assert info["ok"] in (True, None), info
    assert "type_mismatch" not in info, info
    assert info.get("pandas_ok", True), info
