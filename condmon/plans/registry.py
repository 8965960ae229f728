"""Name -> query and name -> oracle SQL for every registered query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from condmon.plans import catalog as C

QueryFn = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, QueryFn]:
    return {
        "bearing_features_stream": C.q_bearing_features_stream,
        "bearing_features_batch": C.q_bearing_features_batch,
        "bearing_entropy": C.q_bearing_entropy,
        "bearing_feature_table": C.q_bearing_feature_table,
        "p2p_batch_vs_stream": C.q_p2p_batch_vs_stream,
        "file_timestamp": C.q_file_timestamp,
        "column_guard_channels": C.q_column_guard_channels,
        "rul_cycles": C.q_rul_cycles,
        "rul_supervised_aligned": C.q_rul_supervised_aligned,
        "topic_route_parse": C.q_topic_route_parse,
        "toolwear_flatten": C.q_toolwear_flatten,
        "json_malformed_quarantine": C.q_json_malformed_quarantine,
        "metadata_lookup_join": C.q_metadata_lookup_join,
        "metadata_ordinal_join": C.q_metadata_ordinal_join,
        "metadata_unpaired": C.q_metadata_unpaired,
        "dropna_any": C.q_dropna_any,
        "candidate_columns": C.q_candidate_columns,
        "experiment_row_counts": C.q_experiment_row_counts,
        "files_streamed": C.q_files_streamed,
        "first_files_sample": C.q_first_files_sample,
        "split_random": C.q_split_random,
        "split_stratified": C.q_split_stratified,
        "split_grouped": C.q_split_grouped,
        "regression_metrics": C.q_regression_metrics,
        "classification_report": C.q_classification_report,
        "label_encode_decode": C.q_label_encode_decode,
        "stream_update_latest": C.q_stream_update_latest,
        "stream_append_scored": C.q_stream_append_scored,
        "stream_serve_both": C.q_stream_serve_both,
        "rul_gbt_predict": C.q_rul_gbt_predict,
        "wear_gbt_predict": C.q_wear_gbt_predict,
        "stream_finalized": C.q_stream_finalized,
        "stream_recovery": C.q_stream_recovery,
        "stream_recovery_state": C.q_stream_recovery_state,
        "stream_empty_batches": C.q_stream_empty_batches,
        "stream_batch_metrics": C.q_stream_batch_metrics,
        "stream_as_soon_as_possible": C.q_stream_as_soon_as_possible,
        "publish_selected": C.q_publish_selected,
        "training_input_checks": C.q_training_input_checks,
        "unreliable_rows": C.q_unreliable_rows,
        "active_machining": C.q_active_machining,
        "elapsed_time": C.q_elapsed_time,
        "snapshot_files": C.q_snapshot_files,
        "snapshot_report": C.q_snapshot_report,
        "stream_raw_replay": C.q_stream_raw_replay,
        "experiment_files": C.q_experiment_files,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "bearing_features_stream": C.sql_bearing_features_stream(),
        "bearing_features_batch": C.sql_bearing_features_batch(),
        "bearing_entropy": C.sql_bearing_entropy(),
        "bearing_feature_table": C.sql_bearing_feature_table(),
        "p2p_batch_vs_stream": C.sql_p2p_batch_vs_stream(),
        "file_timestamp": C.sql_file_timestamp(),
        "column_guard_channels": C.sql_column_guard_channels(),
        "rul_cycles": C.sql_rul_cycles(),
        "rul_supervised_aligned": C.sql_rul_supervised_aligned(),
        "topic_route_parse": C.sql_topic_route_parse(),
        "toolwear_flatten": C.sql_toolwear_flatten(),
        "json_malformed_quarantine": C.sql_json_malformed_quarantine(),
        "metadata_lookup_join": C.sql_metadata_lookup_join(),
        "metadata_ordinal_join": C.sql_metadata_ordinal_join(),
        "metadata_unpaired": C.sql_metadata_unpaired(),
        "dropna_any": C.sql_dropna_any(),
        "candidate_columns": C.sql_candidate_columns(),
        "experiment_row_counts": C.sql_experiment_row_counts(),
        "files_streamed": C.sql_files_streamed(),
        "first_files_sample": C.sql_first_files_sample(),
        "split_random": C.sql_split_random(),
        "split_stratified": C.sql_split_stratified(),
        "split_grouped": C.sql_split_grouped(),
        "regression_metrics": C.sql_regression_metrics(),
        "classification_report": C.sql_classification_report(),
        "label_encode_decode": C.sql_label_encode_decode(),
        # the streamed result must equal the batch aggregate
        "stream_update_latest": C.sql_bearing_features_stream(),
        "stream_finalized": C.sql_bearing_features_stream(),
        "stream_recovery": C.sql_stream_recovery(),
        "stream_recovery_state": C.sql_bearing_features_stream(),
        "stream_empty_batches": C.sql_stream_empty_batches(),
        "stream_batch_metrics": C.sql_stream_batch_metrics(),
        "stream_as_soon_as_possible": C.sql_bearing_features_stream(),
        "publish_selected": C.sql_publish_selected(),
        "training_input_checks": C.sql_training_input_checks(),
        "unreliable_rows": C.sql_unreliable_rows(),
        "active_machining": C.sql_active_machining(),
        "elapsed_time": C.sql_elapsed_time(),
        "snapshot_files": C.sql_snapshot_files(),
        "snapshot_report": C.sql_snapshot_report(),
        "stream_raw_replay": C.sql_stream_raw_replay(),
        "experiment_files": C.sql_experiment_files(),
        "rul_gbt_predict": C.sql_rul_gbt_predict(),
        "wear_gbt_predict": C.sql_wear_gbt_predict(),
        "stream_append_scored": C.sql_stream_append_scored(),
        "stream_serve_both": C.sql_stream_serve_both(),
    }
