"""DataFrame operators: column transforms, dedup, quality profile, quarantine, upsert plan."""
from .chain import apply_chain, compile_chain, compile_transform, is_wide, register_transform
from .columns import DATASET_NAME, INGESTED_AT, add_metadata, cast_columns, drop_columns, rename_columns
from .dedup import dedup_any, dedup_latest
from .quality import (CHECK_MIN_ROWS, CHECK_NULLS, CHECK_SCHEMA, QualityResult, check_quality,
                      check_schema, evaluate, result_frame, run_profile)
from .quarantine import annotate_rows, bad_rows, good_rows, quarantine_batch, quarantine_rows
from .upsert import assert_unique_keys, merge_plan, should_broadcast

__all__ = [
    "apply_chain", "compile_chain", "compile_transform", "is_wide", "register_transform",
    "DATASET_NAME", "INGESTED_AT", "add_metadata", "cast_columns", "drop_columns", "rename_columns",
    "dedup_any", "dedup_latest",
    "CHECK_MIN_ROWS", "CHECK_NULLS", "CHECK_SCHEMA", "QualityResult", "check_quality", "check_schema",
    "evaluate", "result_frame", "run_profile",
    "annotate_rows", "bad_rows", "good_rows", "quarantine_batch", "quarantine_rows",
    "assert_unique_keys", "merge_plan", "should_broadcast",
]
