import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "department", "job", "q1", "q2", "q3", "q4"]
    assert df.count() > 0


EXPECTED = {
    "above_average", "above_average_year", "assign_batches", "assign_ids", "assign_ids_wide", "audit_filter", "csv_by_header", "stream_ingest",
    "backup_restore_roundtrip", "batch_contract", "batch_summary", "batch_transaction", "burst_flags",
    "cascade_keep", "clean_dim", "clean_fk_ids", "clean_names", "clean_null_tokens", "clean_required",
    "clean_stats", "clean_timestamps", "clean_timestamps_strict", "conform_fact", "csv_scan",
    "dataset_profile", "dedup_keep_first", "flag_text_patterns", "full_load", "hash_column",
    "latest_backup", "latest_logs", "left_join_on_filter", "log_date_rollup", "log_filter", "log_search",
    "log_summary", "metric_envelope", "orphan_facts", "parse_envelope", "quarterly_pivot",
    "quarterly_pivot_year", "reject_log", "route_by_id", "rule_fk", "rule_id_range", "rule_id_unused",
    "rule_name_charset", "rule_name_length", "rule_not_future", "rule_required", "rule_ts_format",
    "sanitize_nested", "sanitize_text", "severity_map", "shorten_message", "split_accept_reject",
    "burst_stream", "cascade_delta", "csv_split_records", "format_error", "id_store_probe", "leased_ids", "profile_sample", "restore_without_ids", "stream_flush",
    "star_join", "structure_check", "to_envelope", "unknown_table", "validate_fact",
}


def test_registered_queries_are_all_there():
    # guards against a query being dropped by accident: the set only grows
    assert set(entry.queries()) >= EXPECTED


def test_every_query_has_oracle_or_is_known_rows_only():
    q = entry.queries()
    o = entry.oracle_sql()
    rows_only = set(q) - set(o)
    # the training-data operators are tested against brute force in tests/llm
    assert not {n for n in rows_only if n != "pipeline" and not n.startswith("op")}
    assert len(q) >= 50


def test_small_queries_run(spark):
    for name in ("clean_stats", "log_summary", "batch_summary"):
        assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
