"""
plan test exercises. Used by a test that checks every row is covered."""

# registered query -> inventory rows
QUERY_ROWS: dict[str, tuple[str, ...]] = {
    "local_rows": ("S1", "P6", "JN2", "A5"),
    "json_scan_nested": ("S2", "K2"),
    "csv_scan_typed": ("S4", "K3"),
    "csv_scan_inferred": ("S3", "K3"),
    "csv_scan_multiline": ("S6", "K3"),
    "parquet_roundtrip": ("K1",),
    "json_roundtrip": ("K2",),
    "csv_roundtrip": ("K3", "S5"),
    "csv_quoted_lines": ("S7", "S9", "X6"),
    "csv_delimited_lines": ("S7", "S8"),
    "load_accounting": ("S7", "S13", "F6", "A11"),
    "json_lines_decode": ("S7", "S10"),
    "json_lines_defaults": ("S7", "S10", "N4"),
    "project_topk": ("P1", "R1", "R4"),
    "case_when_distinct": ("P3", "F1", "F2", "F12", "A9"),
    "null_defaults": ("P2", "N1", "N2", "F4"),
    "na_drop_subset": ("N3", "F4"),
    "leading_int": ("X2", "X3", "X4", "X5", "X10"),
    "strip_newlines": ("X4", "N1"),
    "rename_drop": ("P5", "P7"),
    "conform_schema": ("P10", "X10"),
    "prefix_filter_distinct": ("F7", "F11", "X1", "X8", "A9"),
    "date_string_filter": ("F5", "P11"),
    "shift_between_bround": ("P4", "F3", "A2", "X11", "X12", "F12"),
    "group_min_max": ("A1",),
    "group_avg": ("A3",),
    "group_avg_round": ("A14", "X12"),
    "group_sum": ("A4", "A15"),
    "group_count_sorted": ("A5", "R2"),
    "top3_by_count": ("A5", "R5", "R2"),
    "numeric_stats": ("A12", "X13"),
    "distinct_count": ("A10",),
    "global_extremes": ("A13",),
    "global_extreme_records": ("A13",),
    "avg_null_as_zero": ("A7", "N1"),
    "global_avg_attached": ("A8",),
    "mode_month": ("A17", "X19", "F6", "X2", "X3"),
    "group_total_and_mode": ("A16", "A15", "P1"),
    "word_count": ("P12", "X1", "X2", "A5", "F1"),
    "topn_zip_by_rank": ("JN7", "P12", "R2"),
    "season_word_ranks": ("S5", "S11", "JN7", "P12"),
    "top_entity_location_extremes": ("R6", "R7", "P9", "U2", "A15"),
    "top3_weekdays_ru": ("R8", "X20", "X9", "F1"),
    "multi_format_years_since": ("X16", "X17", "X18", "P11"),
    "join_inner_using": ("JN1", "P8", "X15"),
    "join_scaled_distinct": ("JN5", "X11", "X4", "A9", "X15"),
    "join_prepartitioned": ("T2", "JN1"),
    "join_global_avg": ("A6", "JN1"),
    "union_all_rows": ("U1",),
    "join_broadcast_xor_count": ("JN2", "F9", "A11", "T4"),
    "cross_join_range": ("JN3",),
    "salted_join_band_avg": ("JN4", "F8", "X14", "X11", "A3"),
    "lookup_filter_basket": ("JN6", "F10", "A17", "A18", "T4", "P13", "X13"),
    "basket_per_group": ("A17", "A18", "P13"),
    "salted_hot_key_join": ("JN4", "X14", "A5"),
    "csv_pipe_lines": ("S7", "S8", "S9"),
    "weekday_from_epoch": ("X20", "A5"),
    "join_distinct_sorted": ("R3", "JN5", "A9", "P8"),
    "repartition_round_robin": ("T1", "A5"),
    "range_source_join": ("S12", "JN1", "A5"),
    "basket_result_roundtrip": ("K1", "K4"),
    "csv_scan_multiline_split": ("S6", "S9", "K3"),
    "full_rank_zip": ("JN7", "P12", "R2"),
    "top3_heavy_hitters": ("A5", "R5"),
    "bitmap_distinct_counts": ("A10", "K1"),
    "json_lines_strict": ("S7", "S10", "N4"),
    "pruned_partition_basket": ("JN6", "F10", "A17", "A18"),
    "runtime_filter_join": ("JN1", "JN6", "A5"),
    "bucketed_joins": ("T2", "JN1", "A5"),
    "load_accounting_written": ("S7", "S8", "S13", "A11"),
    "merged_states": ("A12", "A14", "A1"),
    "partition_overwrite": ("K1", "F1"),
    "job_parameters": ("K5", "S4", "A2"),
}

# rows exercised by the end-to-end jobs or by plan tests rather than by a
# registered query (each with the place that covers it)
OTHER_ROWS: dict[str, str] = {
    "T3": "broadcast threshold off in the shuffle-study plan tests (tests/test_plans.py)",
    "X7": "not used on purpose: joins use the key columns, not a concatenated key",
}
