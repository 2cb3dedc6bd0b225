"""tidewater: spec-driven batch/stream ingestion on Spark DataFrames.

A dataset spec (source, transforms, quality rules, quarantine, targets) compiles into
ordinary DataFrame plans: Catalyst does the pushdown and pruning, built-in functions do
all per-row work, and writes are staged so a lost executor or driver never leaves a
target half-replaced.
"""
from .errors import (DataQualityError, DuplicateMergeKeyError, MissingOptionError, SpecError,
                     UnknownConnectorError, UnsupportedWriteModeError)
from .operators import check_quality, dedup_latest
from .plans import RunResult, run, run_many
from .session import local_session, work_dir
from .sinks import WriteContext, write_target
from .sources import read_incremental, read_source
from .spec import DatasetSpec, SourceSpec, TargetSpec, load_spec, load_spec_dir, spec_from_dict

__all__ = [
    "DataQualityError", "DuplicateMergeKeyError", "MissingOptionError", "SpecError",
    "UnknownConnectorError", "UnsupportedWriteModeError",
    "RunResult", "run", "run_many", "local_session", "work_dir",
    "check_quality", "dedup_latest", "WriteContext", "write_target", "read_incremental", "read_source",
    "DatasetSpec", "SourceSpec", "TargetSpec", "load_spec", "load_spec_dir", "spec_from_dict",
]
