"""SURVEY section 2 inventory -> registered query keys, with the check tier of each key.

    python -m autoprice.plans.inventory > docs/OPERATORS.md
"""

from __future__ import annotations

INVENTORY = {
    "S1": ["read_csv_header"], "S2": ["read_csv_positional"], "S3": ["read_parquet"], "S4": ["read_dated_csv"],
    "S5": ["stream_json_source", "topic_source"], "S6": ["parse_request"], "S7": ["read_text_dir"], "S8": ["synthetic_cars"],
    "K1": ["write_parquet"], "K2": ["write_partitioned"], "K3": ["write_csv"], "K4": ["write_stats"],
    "K5": ["stream_json_sink"], "K6": ["write_report", "write_final_report"], "K7": ["merge_text"], "K8": ["unique_output_key"],
    "P1": ["car_age"], "P2": ["kms_per_year_plus1"], "P3": ["kms_per_year_guarded"], "P4": ["kms_per_year_rounded"],
    "P5": ["cast_types"], "P6": ["derive_tx_date"], "P7": ["derive_year"], "P8": ["label_map"],
    "P9": ["select_features", "drop_columns"], "P10": ["rename_positional"], "P11": ["new_columns"],
    "P12": ["relative_error_pct"], "P13": ["nest_prediction"],
    "F1": ["drop_null_target"], "F2": ["drop_any_null"], "F3": ["filter_outliers"], "F4": ["filter_year"],
    "F5": ["filter_zero_ids"], "F6": ["filter_min_year"], "F7": ["route_failures"],
    "D1": ["dedupe_rows"], "D2": ["dedupe_stream", "late_safe_dedupe"], "D3": ["impute_mean"], "D4": ["impute_median"],
    "D5": ["impute_mode"], "D6": ["impute_constant"],
    "A1": ["row_counts"], "A2": ["null_profile"], "A3": ["zero_profile"], "A4": ["describe_numeric"],
    "A5": ["target_stats"], "A6": ["group_median", "group_median_sketch"], "A7": ["value_counts_top", "top_values_heavy"], "A8": ["schema_profile"],
    "A9": ["key_null_check"],
    "O1": ["top_k"], "O2": ["head_rows"], "O3": ["sample_fraction", "sample_fraction_bernoulli"], "O4": ["sample_rows"],
    "O5": ["split_random", "split_random_exact"], "O6": ["split_small_guarded"], "O7": ["subsample_train"],
    "O8": ["split_time_ordered"], "O9": ["union_rows"], "O10": ["kfold_assign"], "O11": ["kfold_stratified"],
    "X1": ["scalar_math"], "X2": ["scalar_date"], "X3": ["scalar_string"], "X4": ["scalar_hash"],
    "X5": ["scalar_conditional"], "X6": ["scalar_json"],
    "W1": ["stream_score"], "W2": ["request_count_5m", "request_count_stream"], "W3": ["error_count_5m"],
    "W4": ["latency_p95_5m", "latency_p95"], "W5": ["histogram_buckets"], "W6": ["histogram_quantile"],
    "W7": ["rate_5m"], "W8": ["cpu_pct", "stream_cpu_pct"], "W9": ["active_sources"], "W10": ["threshold_alerts", "stream_alerts"],
    "W11": ["normalise_alert"], "W12": ["late_data", "late_rows"],
    "E1": ["label_encode"], "E2": ["one_hot"], "E3": ["standard_scale"], "E4": ["char_count_vector"],
    "E5": ["assemble_features"], "E6": ["feature_importance"],
    "M1": ["rf_regressor", "forest_regressor", "tree_regressor"], "M2": ["linear_regression", "linear_fit"],
    "M3": ["rf_classifier", "forest_classifier"], "M4": ["cross_validate", "cross_validate_linear"],
    "M5": ["random_search", "random_search_full"], "M6": ["batch_predict", "batch_predict_rows"], "M7": ["model_save_load"],
    "Q1": ["regression_metrics"], "Q2": ["classification_metrics"], "Q3": ["auc_hard_labels"], "Q4": ["non_null_metrics"],
    "B1": ["bootstrap_metrics", "bootstrap_metrics_multinomial", "bootstrap_multinomial_rows"], "B2": ["paired_bootstrap"],
    "B3": ["t_test", "t_test_pvalues", "t_test_full"], "B4": ["effect_size"], "B5": ["deploy_decision"], "B6": ["time_ab_metrics", "time_ab_linear"],
    "B7": ["improvement_pct"], "B8": ["validation_status"], "B9": ["validation_skip"], "B10": ["quality_grade"],
    "B11": ["final_summary"],
    "G1": ["log_run"], "G2": ["register_version", "registry_versions"], "G3": ["latest_version"], "G4": ["resolve_alias"],
    "G5": ["promote"], "G6": ["compare_runs"],
    "J1": ["clean_cars_median"], "J2": ["clean_cars_mean", "clean_cars_job"], "J3": ["clean_transactions", "clean_transactions_job"],
    "J4": ["temperature_etl", "temperature_job"],
    "J5": ["train_price"], "J6": ["train_validate_price"], "J7": ["train_url", "train_url_rows", "ab_test_url"],
    "J8": ["train_linear_baseline"], "J9": ["stream_score_cars", "stream_score_fitted", "stream_score_topic"],
    "J10": ["monitor_predictions", "monitor_alerts", "stream_health", "stream_health_rows", "stream_health_p95"],
}


def main() -> None:
    import sys
    sys.path.insert(0, ".")
    from autoprice.plans import registry
    registry.load_all()
    print("# SURVEY section 2 inventory -> registered queries\n")
    print("Generated by `python -m autoprice.plans.inventory` from the live registry. Tier H = value-for-value "
          "DuckDB oracle at sf0.01; R = rows-only (covered by tests instead).\n")
    print("| ID | key | tier | implemented by |")
    print("| --- | --- | --- | --- |")
    for sid, keys in INVENTORY.items():
        for k in keys:
            fn = registry.QUERIES.get(k)
            tier = "H" if k in registry.ORACLES else ("R" if fn else "MISSING")
            where = f"`{fn.__module__}.{fn.__name__}`" if fn else ""
            print(f"| {sid} | `{k}` | {tier} | {where} |")
    listed = {k for ks in INVENTORY.values() for k in ks}
    extra = sorted(set(registry.QUERIES) - listed)
    if extra:
        print(f"\nAlso registered: {', '.join(f'`{k}`' for k in extra)}")


if __name__ == "__main__":
    main()
