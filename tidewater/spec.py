"""Declarative dataset spec: one YAML/JSON document per dataset.

A spec names a source, an ordered list of transforms, quality rules, an optional
quarantine, and one or more targets. It is plain data; ``plans.ingest.run`` compiles it
into DataFrame plans.
"""
from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from .errors import SpecError, UnsupportedWriteModeError

# source/target type names and their accepted aliases.
SOURCE_ALIASES = {
    "s3_parquet": "parquet",
    "s3_csv": "csv",
    "s3_json": "json",
    "hive": "table",
}
TARGET_ALIASES = {
    "s3": "file",
    "hive": "table",
    "databricks_delta": "delta",
    "snowflake": "warehouse",
}
WRITE_MODES = ("append", "overwrite", "merge", "upsert")
# Fixed value: Spark data source name of the Snowflake connector (default for that alias).
SNOWFLAKE_FORMAT = "net.snowflake.spark.snowflake"

# Spec defaults.
DEFAULT_OWNER = "data-eng"
DEFAULT_SCHEDULE = "@daily"
DEFAULT_MAX_RUNTIME_MINUTES = 60


@dataclass(frozen=True)
class FieldSpec:
    name: str
    type: str
    nullable: bool = True

    def to_struct_field(self) -> StructField:
        return StructField(self.name, _parse_datatype_string(self.type), self.nullable)


@dataclass
class SourceSpec:
    type: str
    options: dict[str, Any] = field(default_factory=dict)
    schema: list[FieldSpec] = field(default_factory=list)
    watermark_column: str | None = None
    # Orders rows that share a watermark: the mark is the pair, so rows that arrive later with the
    # last watermark and a greater tie are read, once.
    watermark_tie_column: str | None = None
    # Rows at or below the watermark that arrive late: "skip", or "new_files" to take them from files
    # written since the last run (Parquet, CSV and JSON folders; every target must merge).
    late_rows: str = "skip"
    # How much earlier than the last run's start a file may have been written and still count as new.
    late_margin_seconds: float = 600.0
    # ``>=`` instead of ``>`` on the watermark; only safe when every target merges.
    watermark_overlap: bool = False
    # Pass the declared schema to file readers (no inference job, no type drift).
    apply_schema: bool = True
    # csv, json and message records that do not parse: "null" (their fields), "fail" (the run),
    # or "quarantine" (the record, with its raw text).
    on_parse_error: str = "null"

    def struct_type(self) -> StructType | None:
        if not self.schema:
            return None
        return StructType([f.to_struct_field() for f in self.schema])


@dataclass
class TransformSpec:
    type: str
    params: dict[str, Any] = field(default_factory=dict)


@dataclass
class TargetSpec:
    type: str
    options: dict[str, Any] = field(default_factory=dict)
    write_mode: str = "append"
    merge_keys: list[str] = field(default_factory=list)
    partition_columns: list[str] = field(default_factory=list)
    name: str | None = None
    # append only: tag rows with ``_batch_id`` and overwrite that partition on replay.
    idempotent: bool = False
    # merge only: "error" (default) raises on duplicate keys in a batch, "allow" keeps them.
    duplicate_keys: str = "error"
    # merge only: treat NULL keys as equal (``<=>``) instead of never matching.
    null_safe_keys: bool = False

    @property
    def id(self) -> str:
        return self.name or self.type

    @property
    def is_merge(self) -> bool:
        return self.write_mode in ("merge", "upsert")


@dataclass
class QualitySpec:
    enabled: bool = True
    min_row_count: int = 0
    max_null_fraction: dict[str, float] = field(default_factory=dict)
    fail_pipeline_on_violation: bool = True
    # "presence" compares names only; "type" also compares declared types.
    schema_level: str = "presence"
    # An incremental run with no new rows succeeds without loading anything.
    skip_if_empty: bool = False


@dataclass
class QuarantineSpec:
    path: str
    # "batch": whole violating batch; "rows": only the rows breaking a row rule.
    mode: str = "batch"
    not_null: list[str] = field(default_factory=list)
    # reason -> SQL predicate every good row satisfies
    rules: dict[str, str] = field(default_factory=dict)


@dataclass
class RetrySpec:
    max_attempts: int = 3
    initial_delay_seconds: float = 2.0
    backoff_multiplier: float = 2.0
    max_delay_seconds: float = 60.0


@dataclass
class DatasetSpec:
    dataset_name: str
    source: SourceSpec
    targets: list[TargetSpec]
    transforms: list[TransformSpec] = field(default_factory=list)
    data_quality: QualitySpec = field(default_factory=QualitySpec)
    quarantine: QuarantineSpec | None = None
    state_path: str | None = None
    audit_path: str | None = None
    # How a batch read more than once is kept: "auto" (checkpoint for sources whose re-read
    # is not reproducible, i.e. jdbc/kafka; executor cache otherwise), "cache", "checkpoint".
    batch_storage: str = "auto"
    description: str = ""
    owner: str = DEFAULT_OWNER
    schedule: str = DEFAULT_SCHEDULE
    # carried as opaque metadata: sla, tags, dependencies, retry
    sla: dict[str, Any] = field(default_factory=lambda: {"max_runtime_minutes": DEFAULT_MAX_RUNTIME_MINUTES})
    tags: list[str] = field(default_factory=list)
    upstream_dependencies: list[str] = field(default_factory=list)
    retry: RetrySpec = field(default_factory=RetrySpec)

    def __post_init__(self) -> None:
        validate(self)

    def target(self, target_id: str) -> TargetSpec:
        for t in self.targets:
            if t.id == target_id:
                return t
        raise SpecError(f"no target {target_id!r} in dataset {self.dataset_name!r}")


def validate(spec: DatasetSpec) -> None:
    name = spec.dataset_name
    if not name or not name.replace("_", "").isalnum():
        raise SpecError("dataset_name must be non-empty and alphanumeric/underscore")
    if not spec.targets:
        raise SpecError("a dataset needs at least one target")
    seen: set[str] = set()
    for t in spec.targets:
        if t.write_mode not in WRITE_MODES:
            raise UnsupportedWriteModeError(f"Unsupported write mode: {t.write_mode}")
        if t.is_merge and not t.merge_keys:
            raise SpecError(f"write_mode={t.write_mode} requires at least one merge_keys entry")
        if t.duplicate_keys not in ("error", "allow"):
            raise SpecError("duplicate_keys must be 'error' or 'allow'")
        if t.id in seen:
            raise SpecError(f"target id {t.id!r} used twice; give targets distinct names")
        seen.add(t.id)
    if spec.source.watermark_tie_column and not spec.source.watermark_column:
        raise SpecError("watermark_tie_column orders rows within a watermark_column; give that too")
    if spec.source.late_rows not in ("skip", "new_files"):
        raise SpecError("late_rows must be 'skip' or 'new_files'")
    if spec.source.late_rows == "new_files":
        if spec.source.type not in ("parquet", "csv", "json") or not spec.source.watermark_column:
            raise SpecError("late_rows: new_files needs a file source with a watermark_column")
        if not all(t.is_merge for t in spec.targets):
            raise SpecError("late_rows: new_files may read a row again; every target must merge")
    if spec.source.watermark_overlap and not all(t.is_merge for t in spec.targets):
        raise SpecError("watermark_overlap re-reads rows at the watermark; every target must merge")
    if spec.source.on_parse_error not in ("null", "fail", "quarantine"):
        raise SpecError("on_parse_error must be 'null', 'fail' or 'quarantine'")
    if spec.source.on_parse_error == "quarantine":
        if spec.quarantine is None:
            raise SpecError("on_parse_error: quarantine needs a quarantine path")
        if spec.source.type not in ("csv", "json", "kafka"):
            raise SpecError(f"a {spec.source.type!r} source has no records that fail to parse")
    if spec.data_quality.schema_level not in ("presence", "type"):
        raise SpecError("schema_level must be 'presence' or 'type'")
    if spec.batch_storage not in ("auto", "cache", "checkpoint"):
        raise SpecError("batch_storage must be 'auto', 'cache' or 'checkpoint'")
    if spec.quarantine is not None and spec.quarantine.mode not in ("batch", "rows"):
        raise SpecError("quarantine.mode must be 'batch' or 'rows'")


# --------------------------------------------------------------------------- parsing

def _fields(raw: list[dict[str, Any]] | None) -> list[FieldSpec]:
    return [FieldSpec(f["name"], f["type"], bool(f.get("nullable", True))) for f in raw or []]


def _source(raw: dict[str, Any]) -> SourceSpec:
    kind = str(raw["type"]).lower()
    return SourceSpec(
        type=SOURCE_ALIASES.get(kind, kind),
        options=dict(raw.get("options") or {}),
        schema=_fields(raw.get("schema", raw.get("schema_fields"))),
        watermark_column=raw.get("watermark_column"),
        watermark_tie_column=raw.get("watermark_tie_column"),
        late_rows=str(raw.get("late_rows", "skip")),
        late_margin_seconds=float(raw.get("late_margin_seconds", 600.0)),
        watermark_overlap=bool(raw.get("watermark_overlap", False)),
        apply_schema=bool(raw.get("apply_schema", True)),
        on_parse_error=str(raw.get("on_parse_error", "null")),
    )


def _target(raw: dict[str, Any]) -> TargetSpec:
    kind = str(raw["type"]).lower()
    options = dict(raw.get("options") or {})
    if kind == "snowflake":
        options.setdefault("format", SNOWFLAKE_FORMAT)
    return TargetSpec(
        type=TARGET_ALIASES.get(kind, kind),
        options=options,
        write_mode=str(raw.get("write_mode", "append")).lower(),
        merge_keys=list(raw.get("merge_keys") or []),
        partition_columns=list(raw.get("partition_columns") or []),
        name=raw.get("name"),
        idempotent=bool(raw.get("idempotent", False)),
        duplicate_keys=str(raw.get("duplicate_keys", "error")),
        null_safe_keys=bool(raw.get("null_safe_keys", False)),
    )


def _transform(raw: dict[str, Any]) -> TransformSpec:
    params = {k: v for k, v in raw.items() if k != "type"}
    return TransformSpec(type=str(raw["type"]).lower(), params=params)


def spec_from_dict(raw: dict[str, Any]) -> DatasetSpec:
    dq = raw.get("data_quality") or {}
    q = raw.get("quarantine")
    retry = raw.get("retry") or {}
    return DatasetSpec(
        dataset_name=raw.get("dataset_name", ""),
        source=_source(raw["source"]),
        targets=[_target(t) for t in raw.get("targets") or []],
        transforms=[_transform(t) for t in raw.get("transforms") or []],
        data_quality=QualitySpec(
            enabled=bool(dq.get("enabled", True)),
            min_row_count=int(dq.get("min_row_count", 0)),
            max_null_fraction={k: float(v) for k, v in (dq.get("max_null_fraction") or {}).items()},
            fail_pipeline_on_violation=bool(dq.get("fail_pipeline_on_violation", True)),
            schema_level=str(dq.get("schema_level", "presence")),
            skip_if_empty=bool(dq.get("skip_if_empty", False)),
        ),
        quarantine=None if not q else QuarantineSpec(
            path=q["path"], mode=q.get("mode", "batch"), not_null=list(q.get("not_null") or []),
            rules=dict(q.get("rules") or {}),
        ),
        state_path=raw.get("state_path"),
        audit_path=raw.get("audit_path"),
        batch_storage=str(raw.get("batch_storage", "auto")),
        description=raw.get("description", ""),
        owner=raw.get("owner", DEFAULT_OWNER),
        schedule=raw.get("schedule", DEFAULT_SCHEDULE),
        sla=dict(raw.get("sla") or {"max_runtime_minutes": DEFAULT_MAX_RUNTIME_MINUTES}),
        tags=list(raw.get("tags") or []),
        upstream_dependencies=list(raw.get("upstream_dependencies") or []),
        retry=RetrySpec(**retry),
    )


def load_spec(path: str | os.PathLike) -> DatasetSpec:
    """Load one spec from ``.yaml``/``.yml``/``.json``."""
    p = Path(path)
    suffix = p.suffix.lower()
    text = p.read_text(encoding="utf-8")
    if suffix in (".yaml", ".yml"):
        try:
            import yaml
        except ImportError as exc:  # pragma: no cover - yaml is baked in
            raise SpecError("PyYAML is required for YAML specs") from exc
        raw = yaml.safe_load(text)
    elif suffix == ".json":
        raw = json.loads(text)
    else:
        raise SpecError(f"Unsupported config extension: {suffix}")
    if not isinstance(raw, dict):
        raise SpecError(f"{p} does not hold a mapping")
    return spec_from_dict(raw)


def load_spec_dir(directory: str | os.PathLike) -> list[DatasetSpec]:
    """All specs in a directory: YAML files first, then JSON, each group sorted by name."""
    d = Path(directory)
    files = sorted([*d.glob("*.yaml"), *d.glob("*.yml")]) + sorted(d.glob("*.json"))
    return [load_spec(f) for f in files]
