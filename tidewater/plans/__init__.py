"""Run plans: the spec-driven ingestion run and its state/audit tables."""
from .ingest import PreparedBatch, RunResult, prepare_batch, process_batch, run, run_many, select_targets
from .state import (StateEntry, audit_frame, commit_state, default_audit_path, default_state_path,
                    latest_state, metrics_frame, read_state, state_frame)

__all__ = [
    "PreparedBatch", "RunResult", "prepare_batch", "process_batch", "run", "run_many", "select_targets",
    "StateEntry", "audit_frame", "commit_state", "default_audit_path", "default_state_path",
    "latest_state", "metrics_frame", "read_state", "state_frame",
]
