"""Quality checks folded into one aggregate pass over the batch.

The profile is a single global aggregate (partial per partition, one tiny final row):
row count, null counts of the limited columns, rows failing row rules, and the
high-water mark of the batch. Checks are then evaluated on the driver from that one
row; nothing else is collected.
"""
from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, StringType, StructField, StructType,
                               _parse_datatype_string)

from ..functions import literal_frame, typed
from ..spec import FieldSpec, QualitySpec

# Check names reported in results and metrics.
CHECK_MIN_ROWS = "min_row_count"
CHECK_NULLS = "max_null_fraction"
CHECK_SCHEMA = "schema_validation"

ROWS = "__rows"
WM_MAX = "__wm_max"
BAD_ROWS = "__bad_rows"


@dataclass
class Violation:
    check: str
    detail: str
    column: str | None = None
    observed: float | None = None
    threshold: float | None = None


@dataclass
class CheckOutcome:
    check: str
    column: str | None
    observed: float | None
    threshold: float | None
    passed: bool
    detail: str


@dataclass
class QualityResult:
    passed: bool
    row_count: int
    violations: list[Violation] = field(default_factory=list)
    outcomes: list[CheckOutcome] = field(default_factory=list)
    profile: dict[str, Any] = field(default_factory=dict)

    @property
    def reason(self) -> str:
        return "; ".join(v.detail for v in self.violations)


def _null_alias(i: int) -> str:
    return f"__nulls_{i}"


def bytes_alias(column: str) -> str:
    return f"__bytes_{column}"


def profile_columns(df: DataFrame, spec: QualitySpec, wm_col: str | None = None,
                    reason_col: str | None = None, size_columns: list[str] | None = None) -> list[Column]:
    """Aggregate expressions of the one-pass profile. ``size_columns`` (variable-width merge
    keys) get their total byte size, which bounds a later broadcast of the batch keys."""
    exprs = [F.count(F.lit(1)).alias(ROWS)]
    for c in size_columns or []:
        if c in df.columns:
            exprs.append(F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`"))), F.lit(0)).alias(bytes_alias(c)))
    for i, c in enumerate(spec.max_null_fraction):
        if c in df.columns:
            exprs.append(F.count_if(F.col(f"`{c}`").isNull()).alias(_null_alias(i)))
    if wm_col and wm_col in df.columns:
        dtype = df.schema[wm_col].dataType
        exprs.append(typed.render(F.max(F.col(f"`{wm_col}`")), dtype).alias(WM_MAX))
    if reason_col and reason_col in df.columns:
        exprs.append(F.count_if(F.col(reason_col) != "").alias(BAD_ROWS))
    return exprs


def run_profile(df: DataFrame, spec: QualitySpec, wm_col: str | None = None,
                reason_col: str | None = None, size_columns: list[str] | None = None) -> dict[str, Any]:
    """One Spark job; returns the single profile row as a dict."""
    row = df.agg(*profile_columns(df, spec, wm_col, reason_col, size_columns)).first()
    return row.asDict() if row is not None else {ROWS: 0}


def check_schema(df: DataFrame, expected: list[FieldSpec], level: str = "presence") -> list[CheckOutcome]:
    """One outcome per declared field: present (and, at ``level="type"``, same type)."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    outcomes = []
    for fs in expected:
        if fs.name not in actual:
            outcomes.append(CheckOutcome(CHECK_SCHEMA, fs.name, None, None, False,
                                         f"missing expected column {fs.name!r}"))
            continue
        if level == "type":
            want = _parse_datatype_string(fs.type)
            if actual[fs.name] != want:
                outcomes.append(CheckOutcome(
                    CHECK_SCHEMA, fs.name, None, None, False,
                    f"column {fs.name!r} has type {actual[fs.name].simpleString()}, "
                    f"expected {want.simpleString()}"))
                continue
        outcomes.append(CheckOutcome(CHECK_SCHEMA, fs.name, None, None, True, "ok"))
    return outcomes


def evaluate(df: DataFrame, profile: dict[str, Any], spec: QualitySpec,
             expected: list[FieldSpec] | None = None) -> QualityResult:
    """Checks in order: row-count floor, null-fraction ceilings, expected columns."""
    rows = int(profile.get(ROWS) or 0)
    if not spec.enabled:
        return QualityResult(True, rows, profile=profile)
    outcomes: list[CheckOutcome] = []
    ok = rows >= spec.min_row_count
    outcomes.append(CheckOutcome(
        CHECK_MIN_ROWS, None, float(rows), float(spec.min_row_count), ok,
        "ok" if ok else f"row_count={rows} < min_row_count={spec.min_row_count}"))
    if rows > 0:
        for i, (c, limit) in enumerate(spec.max_null_fraction.items()):
            if c not in df.columns:
                continue  # reported by the schema check instead of failing analysis
            fraction = int(profile.get(_null_alias(i)) or 0) / rows
            ok = not fraction > limit
            outcomes.append(CheckOutcome(
                CHECK_NULLS, c, fraction, limit, ok,
                "ok" if ok else f"column={c} null_fraction={fraction:.4f} > max={limit}"))
    declared = list(expected or [])
    declared_names = {f.name for f in declared}
    declared += [FieldSpec(c, "string") for c in spec.max_null_fraction
                 if c not in df.columns and c not in declared_names]
    outcomes += check_schema(df, declared, spec.schema_level if expected else "presence")
    violations = [Violation(o.check, o.detail, o.column, o.observed, o.threshold)
                  for o in outcomes if not o.passed]
    return QualityResult(not violations, rows, violations, outcomes, profile)


def check_quality(df: DataFrame, spec: QualitySpec, expected: list[FieldSpec] | None = None,
                  wm_col: str | None = None) -> QualityResult:
    """Profile + evaluate: the whole suite in one Spark job."""
    return evaluate(df, run_profile(df, spec, wm_col), spec, expected)


RESULT_SCHEMA = StructType([
    StructField("dataset", StringType(), False),
    StructField("check_name", StringType(), False),
    StructField("column_name", StringType(), True),
    StructField("observed", DoubleType(), True),
    StructField("threshold", DoubleType(), True),
    StructField("passed", BooleanType(), False),
    StructField("detail", StringType(), False),
])


def result_frame(spark: SparkSession, dataset: str, result: QualityResult) -> DataFrame:
    """Long-form check results: one row per evaluated check (bounded by the spec)."""
    rows = [(dataset, o.check, o.column, o.observed, o.threshold, o.passed, o.detail)
            for o in result.outcomes]
    return literal_frame(spark, rows, RESULT_SCHEMA)
