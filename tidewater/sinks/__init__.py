"""Targets: one function per (type, write mode), a registry for user-defined targets."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import fs
from ..errors import UnknownConnectorError, UnsupportedWriteModeError
from ..spec import TARGET_ALIASES, TargetSpec
from .common import BATCH_ID, WriteContext, WriteReport
from .delta import delta_append, delta_overwrite, delta_upsert
from .files import (compact_marks, file_append, file_overwrite, file_upsert, read_file_target,
                    recover_file_target)
from .tables import recover_table_target, repair_partitions, table_append, table_overwrite, table_upsert
from .warehouse import merge_statement, warehouse_append, warehouse_overwrite, warehouse_upsert

WriteFn = Callable[[SparkSession, DataFrame, TargetSpec, WriteContext], WriteReport]

_REGISTRY: dict[str, dict[str, WriteFn]] = {
    "file": {"append": file_append, "overwrite": file_overwrite, "merge": file_upsert},
    "table": {"append": table_append, "overwrite": table_overwrite, "merge": table_upsert},
    "delta": {"append": delta_append, "overwrite": delta_overwrite, "merge": delta_upsert},
    "warehouse": {"append": warehouse_append, "overwrite": warehouse_overwrite, "merge": warehouse_upsert},
    "jdbc": {"append": warehouse_append, "overwrite": warehouse_overwrite, "merge": warehouse_upsert},
}

# Target types whose append replaces a batch that is written again.
KEYED_APPENDS = ("file", "table")

_RECOVERY = {"file": recover_file_target, "table": recover_table_target}


def register_target(kind: str, append: WriteFn | None = None, overwrite: WriteFn | None = None,
                    merge: WriteFn | None = None) -> None:
    """Add or replace a target type; modes left out are unsupported for it."""
    _REGISTRY[kind.lower()] = {m: fn for m, fn in
                               (("append", append), ("overwrite", overwrite), ("merge", merge)) if fn}


def write_target(spark: SparkSession, df: DataFrame, target: TargetSpec,
                 ctx: WriteContext | None = None) -> WriteReport:
    """Dispatch on target type and write mode (``upsert`` is ``merge``)."""
    kind = target.type.lower()
    modes = _REGISTRY.get(TARGET_ALIASES.get(kind, kind))
    if modes is None:
        raise UnknownConnectorError(f"Unsupported target type: {target.type}")
    mode = "merge" if target.write_mode in ("merge", "upsert") else target.write_mode
    fn = modes.get(mode)
    if fn is None:
        raise UnsupportedWriteModeError(f"Unsupported write mode: {target.write_mode} for {target.type}")
    ctx = ctx or WriteContext()
    if target.idempotent and mode == "append" and TARGET_ALIASES.get(kind, kind) not in KEYED_APPENDS:
        raise UnsupportedWriteModeError(f"idempotent append is not supported for {target.type}")
    if mode == "merge" and ctx.batch_rows == 0 and _exists(spark, target):
        # merging nothing changes nothing: do not rewrite the target
        return WriteReport(target.id, target.type, "merge", 0, str(target.options.get("path")
                                                                     or target.options.get("table", "")),
                           extra={"scope": "empty"})
    return fn(spark, df, target, ctx)


def _exists(spark: SparkSession, target: TargetSpec) -> bool:
    """Whether the target is there already; a first merge creates it, rows or not."""
    if target.options.get("path"):
        return fs.exists(spark, str(target.options["path"]))
    table = target.options.get("table")
    return not table or spark.catalog.tableExists(str(table))


def recover_target(spark: SparkSession, target: TargetSpec) -> bool:
    kind = target.type.lower()
    fn = _RECOVERY.get(TARGET_ALIASES.get(kind, kind))
    return bool(fn and target.is_merge and fn(spark, target))


__all__ = [
    "BATCH_ID", "WriteContext", "WriteReport", "write_target", "register_target",
    "recover_target", "read_file_target", "compact_marks", "repair_partitions", "merge_statement",
]
