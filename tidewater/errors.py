"""Error types raised by the library."""
from __future__ import annotations


class SpecError(ValueError):
    """A dataset spec is malformed or inconsistent."""


class MissingOptionError(SpecError):
    """A source or target lacks an option it cannot work without."""


class UnsupportedWriteModeError(SpecError):
    """A target asks for a write mode that is not append/overwrite/merge/upsert."""


class UnknownConnectorError(SpecError):
    """No source or target is registered under the requested type."""


class DuplicateMergeKeyError(RuntimeError):
    """A merge batch holds more than one row for some merge key."""


class TargetBusyError(RuntimeError):
    """Another run holds the target longer than this one is willing to wait."""


class DataQualityError(RuntimeError):
    """The quality gate failed and the spec asks the run to stop."""

    def __init__(self, dataset_name: str, result) -> None:
        self.result = result
        details = [v.detail for v in result.violations]
        super().__init__(f"Data quality checks failed for {dataset_name!r}: {details}")
