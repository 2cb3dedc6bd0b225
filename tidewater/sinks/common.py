"""Shared pieces of the sinks: write context/report, observed writes, output layout."""
from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructField, StructType

from ..errors import SpecError
from ..functions import content_hash
from ..operators.upsert import DEFAULT_BROADCAST_LIMIT
from ..spec import TargetSpec

BATCH_ID = "_batch_id"
# File systems whose directory rename is atomic.
ATOMIC_RENAME_SCHEMES = ("hdfs", "viewfs", "file")


def commit_mode(spark, requested: str, location: str) -> str:
    """``rename`` or ``copy``; ``auto`` renames where a directory rename is atomic."""
    if requested == "auto":
        from .. import fs

        return "rename" if fs.scheme(spark, location) in ATOMIC_RENAME_SCHEMES else "copy"
    return requested


@dataclass
class WriteContext:
    """What the run knows about the batch when it writes a target."""
    batch_id: int = 0
    batch_rows: int | None = None
    # measured bytes of each variable-width column of the batch (merge keys), if profiled
    column_bytes: dict[str, int] = field(default_factory=dict)
    keys_unique: bool = False
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT
    run_time: _dt.datetime = field(default_factory=lambda: _dt.datetime.now(_dt.timezone.utc))

    def var_key_bytes(self, keys: list[str]) -> int | None:
        """Measured bytes of the variable-width keys; None if any of them was not profiled."""
        return sum(self.column_bytes[k] for k in keys) if all(k in self.column_bytes for k in keys) else None


@dataclass
class WriteReport:
    target: str
    type: str
    mode: str
    rows: int
    location: str
    checksum: str | None = None
    extra: dict[str, Any] = field(default_factory=dict)


def observed(df: DataFrame, with_hash: bool) -> tuple[DataFrame, Observation]:
    """Attach a row count (and content hash) that the write job computes as it runs."""
    obs = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    if with_hash:
        maps = {f.name for f in df.schema.fields if isinstance(f.dataType, MapType)}
        metrics.append(content_hash(df.columns, maps).cast("string").alias("checksum"))
    return df.observe(obs, *metrics), obs


def observed_metrics(obs: Observation) -> dict[str, Any]:
    got = obs.get or {}
    return {"rows": int(got.get("rows") or 0), "checksum": got.get("checksum")}


def rebalance(df: DataFrame, partition_columns: list[str]) -> DataFrame:
    """Before a partitioned write: cluster rows by partition value so each value lands in
    few files, while AQE splits a value that holds a large share of the rows across
    several tasks (``REBALANCE`` hint) instead of one."""
    cols = [c for c in partition_columns if c != BATCH_ID]
    if not cols:
        return df
    return df.hint("rebalance", *cols)


def with_typed_partitions(read_schema: StructType, batch_schema: StructType,
                          partition_columns: list[str]) -> StructType:
    """Schema for reading a partitioned target back: partition columns take the batch's
    types instead of values inferred from directory names (``"01"`` would become 1)."""
    batch_types = {f.name: f.dataType for f in batch_schema.fields}
    fields = []
    for f in read_schema.fields:
        if f.name in partition_columns and f.name in batch_types:
            fields.append(StructField(f.name, batch_types[f.name], True))
        else:
            fields.append(f)
    return StructType(fields)


def version_columns(target: TargetSpec) -> list[str]:
    given = target.options.get("version_column")
    return [given] if isinstance(given, str) else list(given or [])


def rewrite_scope(target: TargetSpec) -> str:
    scope = str(target.options.get("rewrite", "partitions"))
    if scope not in ("partitions", "files", "marks"):
        raise SpecError("rewrite must be 'partitions', 'files' or 'marks'")
    if scope == "marks" and target.options.get("format", "parquet") != "parquet":
        raise SpecError("rewrite: marks needs Parquet, whose scans know row positions")
    return scope
