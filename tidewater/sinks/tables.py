"""Catalog-table targets (any catalog ``saveAsTable`` works with; Parquet by default).

Options: ``table`` (required), ``path`` (external location), ``format``, ``repair``
(run ``MSCK REPAIR`` after partitioned writes), ``bucket_count`` (bucket the table by
its merge keys), ``commit`` (``auto`` | ``rename`` | ``copy``), ``schema_evolution``
(default on: an append adds the batch's new columns to the table first).

Upserts write the combined result to a stage table first (a table cannot be overwritten
by a query that reads it); its name carries the scope (``<table>__stage_full`` or
``__stage_dyn``). A stage table exists in the catalog only once its data is written, so
a run that finds one re-applies it. The stage is committed by

* ``rename`` (external tables on HDFS/local paths): the stage's folder replaces the
  live folder by two atomic renames and the table is refreshed (and its partitions
  re-synced) — the data is written once;
* ``copy``: ``INSERT OVERWRITE`` of the live table from the stage (only the touched
  partitions when the partition columns are in the merge key). The live table is never
  dropped, so there is no window in which it is missing. If the batch adds columns the
  live table is replaced from the stage instead.

With ``bucket_count`` the target is bucketed by the merge keys, so the upsert's anti
join reads the target without shuffling it; only the batch keys are shuffled.

An external table partitioned by columns outside the merge key is upserted through its
folder like a file target (only partitions holding a matched key or receiving batch rows
are rewritten, emptied ones removed) and those partitions are then registered or dropped in the catalog. With
``rewrite: files`` any external table that is not bucketed is upserted through its folder, file by
file. ``version_column`` guards an upsert as it does for file targets.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fs
from ..errors import MissingOptionError, SpecError
from ..operators.upsert import (DEFAULT_PARTITION_NAME, any_key_matches, assert_unique_keys, few_keys, is_variable_width,
                                merge_by_version, merge_plan, newest_rows, should_broadcast, touched_partitions)
from ..spec import TargetSpec
from .common import (BATCH_ID, WriteContext, WriteReport, commit_mode, observed, observed_metrics, rebalance,
                     rewrite_scope, version_columns)


def _table(target: TargetSpec) -> str:
    table = target.options.get("table")
    if not table:
        raise MissingOptionError("Table target requires 'table' option")
    return str(table)


def _location(target: TargetSpec, suffix: str = "") -> str | None:
    loc = target.options.get("path")
    return f"{str(loc).rstrip('/')}{suffix}" if loc else None


def _create(df: DataFrame, target: TargetSpec, table: str, mode: str, location: str | None,
            partition_columns: list[str], with_hash: bool = False) -> dict:
    buckets = int(target.options.get("bucket_count", 0) or 0)
    if partition_columns and not buckets:
        df = rebalance(df, partition_columns)
    df, obs = observed(df, with_hash)
    writer = df.write.format(str(target.options.get("format", "parquet"))).mode(mode)
    if location:
        writer = writer.option("path", location)
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    if buckets and target.merge_keys:
        writer = writer.bucketBy(buckets, *target.merge_keys)
    writer.saveAsTable(table)
    return observed_metrics(obs)


def _insert_overwrite(spark: SparkSession, df: DataFrame, table: str, dynamic: bool) -> dict:
    cols = spark.table(table).columns  # insertInto is positional: follow the table's order
    df, obs = observed(df.select(*[F.col(f"`{c}`") for c in cols]), False)
    # explicit either way: never inherit the session's default overwrite mode
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    writer.insertInto(table, overwrite=True)
    return observed_metrics(obs)


def repair_partitions(spark: SparkSession, table: str, sync: bool = False) -> None:
    """Register partition directories written outside the catalog (``sync`` also drops
    partitions whose directories are gone)."""
    spark.sql(f"MSCK REPAIR TABLE {table}{' SYNC PARTITIONS' if sync else ''}")


def register_partitions(spark: SparkSession, table: str, columns: list[str], add: list[tuple], drop: list[tuple],
                        batch: int = 200) -> None:
    """Tell the catalog of a write's own partitions; folders it did not touch are not listed. Values
    are those of folder names; an external table's dropped partitions keep their (empty) place."""
    def spec(values: tuple) -> str:
        shown = ["null" if v == DEFAULT_PARTITION_NAME else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
                 for v in values]
        return "PARTITION (" + ", ".join(f"`{c}` = {v}" for c, v in zip(columns, shown, strict=True)) + ")"

    for rows, words, comma in ((add, "ADD IF NOT EXISTS", " "), (drop, "DROP IF EXISTS", ", ")):
        for at in range(0, len(rows), batch):
            spark.sql(f"ALTER TABLE {table} {words} " + comma.join(spec(v) for v in rows[at: at + batch]))


def _maybe_repair(spark: SparkSession, target: TargetSpec) -> None:
    if target.partition_columns and target.options.get("repair", False):
        repair_partitions(spark, _table(target))


def _add_new_columns(spark: SparkSession, target: TargetSpec, df: DataFrame) -> None:
    """Schema evolution on append (``schema_evolution``, default on): columns the batch
    brings are added to the table first, so older rows read them as NULL."""
    table = _table(target)
    if not target.options.get("schema_evolution", True) or not spark.catalog.tableExists(table):
        return
    present = {c.lower() for c in spark.table(table).columns}
    new = [f for f in df.schema.fields if f.name.lower() not in present]
    if new:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")


def table_append(spark: SparkSession, df: DataFrame, target: TargetSpec, ctx: WriteContext) -> WriteReport:
    table = _table(target)
    pcols = list(target.partition_columns)
    _add_new_columns(spark, target, df)
    if target.idempotent:
        df = df.withColumn(BATCH_ID, F.lit(int(ctx.batch_id)).cast("int"))
        if spark.catalog.tableExists(table):
            metrics = _insert_overwrite(spark, df, table, dynamic=True)
        else:
            metrics = _create(df, target, table, "overwrite", _location(target), [BATCH_ID] + pcols)
    else:
        metrics = _create(df, target, table, "append", _location(target), pcols)
    _maybe_repair(spark, target)
    return WriteReport(target.id, target.type, "append", metrics["rows"], table)


def table_overwrite(spark: SparkSession, df: DataFrame, target: TargetSpec, ctx: WriteContext) -> WriteReport:
    """Replace the table. An existing table is replaced from a complete stage table
    (``saveAsTable(mode="overwrite")`` would drop it before the new data exists)."""
    table = _table(target)
    pcols = list(target.partition_columns)
    recover_table_target(spark, target)
    if not spark.catalog.tableExists(table):
        metrics = _create(df, target, table, "overwrite", _location(target), pcols)
        _maybe_repair(spark, target)
        return WriteReport(target.id, target.type, "overwrite", metrics["rows"], table)
    stage = _stage_name(table, False)
    spark.sql(f"DROP TABLE IF EXISTS {stage}")
    stage_loc = _location(target, _stage_suffix(False))
    if stage_loc:
        fs.delete(spark, stage_loc)
    staged = _create(df, target, stage, "overwrite", stage_loc, pcols)
    metrics = _apply_stage(spark, target, False)
    rows = staged["rows"] if metrics["rows"] is None else metrics["rows"]
    return WriteReport(target.id, target.type, "overwrite", rows, table,
                       extra={"commit": _commit_mode(spark, target, False)})


def _stage_name(table: str, dynamic: bool) -> str:
    # The scope is part of the name: a partition-scoped stage holds only the touched
    # partitions and must never be applied as a full overwrite.
    return f"{table}__stage_{'dyn' if dynamic else 'full'}"


def _stage_suffix(dynamic: bool) -> str:
    return f"__stage_{'dyn' if dynamic else 'full'}"


def _commit_mode(spark: SparkSession, target: TargetSpec, dynamic: bool) -> str:
    live = _location(target)
    if dynamic or live is None:
        return "copy"
    return commit_mode(spark, str(target.options.get("commit", "auto")), live)


def _swap_folders(spark: SparkSession, target: TargetSpec) -> None:
    """Stage folder replaces the live folder; the catalog entry keeps its location."""
    table = _table(target)
    live, stage, old = _location(target), _location(target, _stage_suffix(False)), _location(target, "__old")
    fs.delete(spark, old)
    if fs.exists(spark, live):
        fs.rename(spark, live, old)
    fs.rename(spark, stage, live)
    fs.delete(spark, old)
    spark.sql(f"REFRESH TABLE {table}")
    if target.partition_columns:
        repair_partitions(spark, table, sync=True)


def _apply_stage(spark: SparkSession, target: TargetSpec, dynamic: bool) -> dict:
    table = _table(target)
    stage = _stage_name(table, dynamic)
    staged = spark.table(stage)
    live_cols = {c.lower() for c in spark.table(table).columns}
    staged_cols = {c.lower() for c in staged.columns}
    if staged_cols > live_cols and target.options.get("schema_evolution", True):
        _add_new_columns(spark, target, staged)  # the table keeps its identity, no drop
        live_cols = staged_cols
    same_columns = staged_cols == live_cols
    if same_columns and _commit_mode(spark, target, dynamic) == "rename":
        spark.sql(f"DROP TABLE IF EXISTS {stage}")  # external: the folder stays
        _swap_folders(spark, target)
        return {"rows": None, "checksum": None}
    if same_columns:
        metrics = _insert_overwrite(spark, staged, table, dynamic)
    else:  # columns removed (an overwrite with another schema): replace the table definition
        metrics = _create(staged, target, table, "overwrite", _location(target), list(target.partition_columns))
    spark.sql(f"DROP TABLE IF EXISTS {stage}")
    stage_loc = _location(target, _stage_suffix(dynamic))
    if stage_loc:
        fs.delete(spark, stage_loc)
    _maybe_repair(spark, target)
    return metrics


def recover_table_target(spark: SparkSession, target: TargetSpec) -> bool:
    """Re-apply a stage table left by an interrupted upsert; undo a half-done swap."""
    table = _table(target)
    recovered = False
    old, live = _location(target, "__old"), _location(target)
    if old and fs.exists(spark, old):
        if not fs.exists(spark, live):
            fs.rename(spark, old, live)  # the stage entry was already gone: roll back
            spark.sql(f"REFRESH TABLE {table}")
            recovered = True
        fs.delete(spark, old)
    for dynamic in (True, False):
        if spark.catalog.tableExists(_stage_name(table, dynamic)) and spark.catalog.tableExists(table):
            _apply_stage(spark, target, dynamic)
            recovered = True
    return recovered


def table_upsert(spark: SparkSession, df: DataFrame, target: TargetSpec, ctx: WriteContext) -> WriteReport:
    version = version_columns(target)
    if not version:
        return _table_upsert(spark, df, target, ctx, [])
    newest = newest_rows(df, list(target.merge_keys), version, target.null_safe_keys).persist()
    try:
        return _table_upsert(spark, newest, target, ctx, version)
    finally:
        newest.unpersist()


def _table_upsert(spark: SparkSession, df: DataFrame, target: TargetSpec, ctx: WriteContext,
                  version: list[str]) -> WriteReport:
    table = _table(target)
    scoped = rewrite_scope(target)
    if scoped == "marks":
        raise SpecError("rewrite: marks is for file targets; readers of a table would not leave marked rows out")
    keys = list(target.merge_keys)
    pcols = list(target.partition_columns)
    recover_table_target(spark, target)
    if target.duplicate_keys == "error" and not ctx.keys_unique and not version:
        assert_unique_keys(df, keys, target.null_safe_keys)
    if not spark.catalog.tableExists(table):
        metrics = _create(df, target, table, "overwrite", _location(target), pcols)
        return WriteReport(target.id, target.type, "merge", metrics["rows"], table, extra={"scope": "create"})
    existing = spark.table(table)
    buckets = int(target.options.get("bucket_count", 0) or 0)
    by_folder = scoped == "files" or (pcols and not set(pcols) <= set(keys))
    if by_folder and _location(target) and not buckets and set(df.columns) <= set(existing.columns):
        # Keys may move between partitions: upsert the table's folder partition by
        # partition (or file by file) like a file target, then sync the catalog.
        from .files import PARTITIONS, file_upsert

        folder = TargetSpec("file", {"path": _location(target), "format": target.options.get("format", "parquet"),
                                     "commit": target.options.get("commit", "auto"), "rewrite": scoped,
                                     "version_column": version},
                            write_mode="merge", merge_keys=keys, partition_columns=pcols,
                            duplicate_keys=target.duplicate_keys, null_safe_keys=target.null_safe_keys)
        ordered = df.select(*[F.col(f"`{c}`") for c in existing.columns if c in df.columns])
        report = file_upsert(spark, ordered, folder, WriteContext(
            batch_id=ctx.batch_id, batch_rows=ctx.batch_rows, column_bytes=ctx.column_bytes,
            keys_unique=True, broadcast_limit=ctx.broadcast_limit, run_time=ctx.run_time))  # checked above
        spark.sql(f"REFRESH TABLE {table}")
        known = report.extra.pop(PARTITIONS, None)
        if pcols and known is not None:
            register_partitions(spark, table, pcols, *known)
        elif pcols:
            repair_partitions(spark, table, sync=True)
        return WriteReport(target.id, target.type, "merge", report.rows, table, extra=report.extra)
    dynamic = False
    var_keys = [k for k in keys if is_variable_width(df, k)]
    broadcast = should_broadcast(df, keys, ctx.batch_rows, ctx.broadcast_limit,
                                 ctx.var_key_bytes(var_keys) if var_keys else None) or bool(version) and few_keys(df, keys)
    # Partition-scoped only with the partition columns inside the merge key: then no key
    # can leave a partition, so no partition is emptied by the upsert.
    if pcols and set(pcols) <= set(keys) and set(df.columns) <= set(existing.columns):
        existing = touched_partitions(df, pcols).restrict(existing)
        dynamic = True
    if (target.options.get("insert_probe", True) and set(df.columns) <= set(existing.columns)
            and not any_key_matches(existing, df, keys, target.null_safe_keys, broadcast)):
        # insert-only batch: append by name, rewrite nothing (a replay takes the merge path)
        metrics = _create(df, target, table, "append", _location(target), pcols)
        _maybe_repair(spark, target)
        return WriteReport(target.id, target.type, "merge", metrics["rows"], table,
                           extra={"scope": "insert", "broadcast": broadcast})
    if version:
        combined = merge_by_version(existing, df, keys, version, target.null_safe_keys, broadcast)
    else:
        combined = merge_plan(existing, df, keys, null_safe=target.null_safe_keys, broadcast_keys=broadcast,
                              distinct_keys=target.duplicate_keys == "allow")
    stage = _stage_name(table, dynamic)
    spark.sql(f"DROP TABLE IF EXISTS {stage}")
    stage_loc = _location(target, _stage_suffix(dynamic))
    if stage_loc:
        fs.delete(spark, stage_loc)
    staged = _create(combined, target, stage, "overwrite", stage_loc, pcols)
    commit = _commit_mode(spark, target, dynamic)
    metrics = _apply_stage(spark, target, dynamic)
    rows = staged["rows"] if metrics["rows"] is None else metrics["rows"]
    return WriteReport(target.id, target.type, "merge", rows, table,
                       extra={"scope": "dynamic" if dynamic else "static", "broadcast": broadcast,
                              "commit": commit})
