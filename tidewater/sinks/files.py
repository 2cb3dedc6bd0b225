"""File targets (Parquet by default, any file format Spark writes) on any shared path.

Upserts never overwrite a path while reading it: the combined result is first written
to a stage directory next to the target (``<path>__stage_<scope>``), whose ``_SUCCESS``
marker says it is complete. The stage is then committed:

* ``rename`` (default on HDFS and local paths, whose directory renames are atomic
  metadata operations): target → ``<path>__old``, stage → target, old deleted — or, for
  a partition-scoped upsert, the same per touched partition folder. The data is written
  once.
* ``copy`` (default elsewhere, e.g. object stores where a rename is a copy): the target
  is overwritten from the stage, then the stage is removed.

A run that starts and finds a complete stage re-applies it (idempotent); an incomplete
one is discarded; a half-finished swap is completed or rolled back. When the partition
columns are part of the merge key, only the partitions the batch touches are read and
rewritten (dynamic partition overwrite from the stage); otherwise the partitions holding
a matched key are found first by a semi join on the target's key columns, so an upsert
into a date-partitioned, id-keyed target still rewrites only the partitions it touches.

``rewrite: files`` narrows that to the files holding a matched key, ``rewrite: marks`` to the
positions of the matched rows (see ``rewrite``). ``version_column`` (one or a list) guards an upsert:
the newest row of a key by those columns stays, whether the batch or the target has it.
"""
from __future__ import annotations

import datetime as _dt
import json
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .. import fs
from ..functions import literal_frame
from ..errors import MissingOptionError
from ..operators.upsert import (Touched, any_key_matches, assert_unique_keys, few_keys, is_variable_width,
                                merge_by_version, merge_plan, newest_rows, should_broadcast, touched_partitions)
from ..spec import TargetSpec
from . import rewrite
from .common import (BATCH_ID, WriteContext, WriteReport, commit_mode, observed, observed_metrics,
                     rebalance, rewrite_scope, version_columns, with_typed_partitions)

STAGE_SCOPES = ("dynamic", "static")
#: In a report: the values of the partitions a write put rows into, and of those it emptied.
PARTITIONS = "partitions"
MANIFEST_SCHEMA = StructType([
    StructField("path", StringType()), StructField("row_count", LongType()),
    StructField("written_at", StringType()), StructField("checksum", StringType()),
    StructField("mode", StringType()), StructField("batch_id", LongType()),
    StructField("total_rows", LongType()),
])


def _path(target: TargetSpec) -> str:
    path = target.options.get("path")
    if not path:
        raise MissingOptionError("File target requires 'path' option")
    return str(path).rstrip("/")


def _format(target: TargetSpec) -> str:
    return str(target.options.get("format", "parquet"))


def _write_options(target: TargetSpec) -> dict[str, str]:
    return {k: str(v) for k, v in (target.options.get("write_options") or {}).items()}


def _save(df: DataFrame, target: TargetSpec, path: str, mode: str, partition_columns: list[str],
          dynamic: bool = False, with_hash: bool = False) -> dict:
    if partition_columns:
        df = rebalance(df, partition_columns)
    df, obs = observed(df, with_hash)
    writer = df.write.format(_format(target)).mode(mode).options(**_write_options(target))
    if mode == "overwrite":  # explicit either way: never inherit the session's default
        writer = writer.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    writer.save(path)
    return observed_metrics(obs)


def write_manifest(spark: SparkSession, manifest_path: str, location: str, metrics: dict,
                   mode: str, batch_id: int, total_rows: int | None = None) -> None:
    """One-row JSON: location, rows written by this write and their content checksum, UTC
    time, and the target's total row count after it."""
    row = (location, int(metrics["rows"]), _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"),
           metrics.get("checksum"), mode, int(batch_id), total_rows)
    literal_frame(spark, [row], MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").json(manifest_path)


def _report(spark, target, mode, path, metrics, ctx, **extra) -> WriteReport:
    manifest = target.options.get("manifest_path")
    if manifest:
        # a column-free count: answered from Parquet footers, no data pages read
        total = (read_file_target(spark, target) if rewrite_scope(target) == "marks"
                 else spark.read.format(_format(target)).load(path)).count()
        write_manifest(spark, str(manifest), path, metrics, mode, ctx.batch_id, total)
    return WriteReport(target.id, target.type, mode, metrics["rows"], path, metrics.get("checksum"), extra)


def file_append(spark: SparkSession, df: DataFrame, target: TargetSpec, ctx: WriteContext) -> WriteReport:
    path = _path(target)
    pcols = list(target.partition_columns)
    with_hash = bool(target.options.get("manifest_path"))
    if target.idempotent:
        # A batch owns its folder: a replay replaces all of it, whatever partitions it now has.
        own = f"{path}/{BATCH_ID}={int(ctx.batch_id)}"
        metrics = _save(df, target, own, "overwrite", pcols, with_hash=with_hash)
    else:
        metrics = _save(df, target, path, "append", pcols, with_hash=with_hash)
    return _report(spark, target, "append", path, metrics, ctx)


def file_overwrite(spark: SparkSession, df: DataFrame, target: TargetSpec, ctx: WriteContext) -> WriteReport:
    """Replace the target. A full replace is staged like an upsert, so the old data stays
    readable until the new data is complete (a failed job leaves the target as it was);
    ``overwrite_scope: partitions`` uses Spark's dynamic partition overwrite, which only
    swaps in the written partitions at job commit."""
    path = _path(target)
    pcols = list(target.partition_columns)
    with_hash = bool(target.options.get("manifest_path"))
    if target.options.get("overwrite_scope", "table") == "partitions" and pcols:
        metrics = _save(df, target, path, "overwrite", pcols, dynamic=True, with_hash=with_hash)
        return _report(spark, target, "overwrite", path, metrics, ctx, scope="partitions")
    recover_file_target(spark, target)
    if not fs.exists(spark, path):
        metrics = _save(df, target, path, "overwrite", pcols, with_hash=with_hash)
        return _report(spark, target, "overwrite", path, metrics, ctx, scope="create")
    stage = _stage_path(path, "static")
    _clear_stage(spark, stage)
    fs.write_text(spark, stage + ".schema.json", df.schema.json())
    commit = _commit_mode(spark, target, path)
    metrics = _save(df, target, stage, "overwrite", pcols, with_hash=with_hash and commit == "rename")
    if commit == "rename":
        _swap_in(spark, path, stage)
    else:
        metrics = _apply_stage(spark, target, path, "static", df.schema)
        _clear_stage(spark, stage)
    fs.delete(spark, rewrite.marks_path(path))  # they name files that are gone
    return _report(spark, target, "overwrite", path, metrics, ctx, scope="table", commit=commit)


def _stage_path(path: str, scope: str) -> str:
    return f"{path}__stage_{scope}"


def _apply_stage(spark: SparkSession, target: TargetSpec, path: str, scope: str,
                 schema: StructType) -> dict:
    """Copy commit: overwrite the target (only the staged partitions when dynamic)."""
    stage = _stage_path(path, scope)
    staged = spark.read.format(_format(target)).schema(schema).load(stage)
    return _save(staged, target, path, "overwrite", list(target.partition_columns),
                 dynamic=(scope == "dynamic"), with_hash=bool(target.options.get("manifest_path")))


def _commit_mode(spark: SparkSession, target: TargetSpec, path: str) -> str:
    return commit_mode(spark, str(target.options.get("commit", "auto")), path)


def _clear_stage(spark: SparkSession, stage: str) -> None:
    fs.delete(spark, stage)
    fs.delete(spark, stage + ".schema.json")
    fs.delete(spark, stage + ".plan.json")


def _swap_in(spark: SparkSession, path: str, stage: str) -> None:
    old = f"{path}__old"
    fs.delete(spark, old)
    if fs.exists(spark, path):
        fs.rename(spark, path, old)
    fs.rename(spark, stage, path)
    fs.delete(spark, old)
    _clear_stage(spark, stage)
    spark.catalog.refreshByPath(path)


def _folder_values(rel: str) -> tuple[str, ...]:
    """``a=x/b=y%3Az`` → ``("x", "y:z")`` (Spark escapes special characters as %XX)."""
    return tuple(unquote(part.split("=", 1)[1]) for part in rel.split("/"))


def _partition_plan(spark: SparkSession, path: str, stage: str, depth: int, touched: Touched) -> dict:
    """Folders to replace from the stage, and touched live folders the upsert emptied
    (every row of theirs moved to another partition) which must be removed."""
    staged = fs.partition_dirs(spark, stage, depth)
    live = [rel for rel in fs.partition_dirs(spark, path, depth) if _folder_values(rel) in touched.folder_values]
    return {"replace": staged, "remove": sorted(set(live) - set(staged))}


def _commit_partitions(spark: SparkSession, target: TargetSpec, path: str, stage: str, plan: dict,
                       commit: str, schema: StructType) -> dict | None:
    """Apply a partition plan; re-running it after a crash finishes the remaining steps."""
    old = f"{path}__old"
    metrics = None
    if commit == "rename":
        for rel in plan["replace"]:
            if not fs.exists(spark, f"{stage}/{rel}"):
                continue  # already moved in
            live_p, old_p = f"{path}/{rel}", f"{old}/{rel}"
            if fs.exists(spark, live_p):
                fs.delete(spark, old_p)
                fs.mkdirs(spark, old_p.rsplit("/", 1)[0])
                fs.rename(spark, live_p, old_p)
            fs.mkdirs(spark, live_p.rsplit("/", 1)[0])
            fs.rename(spark, f"{stage}/{rel}", live_p)
    else:
        metrics = _apply_stage(spark, target, path, "dynamic", schema)
    for rel in plan["remove"]:
        fs.delete(spark, f"{path}/{rel}")
    fs.delete(spark, old)
    _clear_stage(spark, stage)
    spark.catalog.refreshByPath(path)
    return metrics


def recover_file_target(spark: SparkSession, target: TargetSpec) -> bool:
    """Finish or discard an upsert interrupted after/before its stage was complete."""
    path = _path(target)
    recovered = rewrite.recover(spark, path)
    old = f"{path}__old"
    dynamic_stage = _stage_path(path, "dynamic")
    if fs.exists(spark, old) and not fs.exists(spark, dynamic_stage + ".plan.json"):
        stage = _stage_path(path, "static")
        if not fs.exists(spark, path):
            # died between the two renames: finish with the stage, else roll back
            fs.rename(spark, stage if fs.is_complete(spark, stage) else old, path)
            recovered = True
        fs.delete(spark, old)
    commit = _commit_mode(spark, target, path)
    for scope in STAGE_SCOPES:
        stage = _stage_path(path, scope)
        schema_file = stage + ".schema.json"
        plan_file = stage + ".plan.json"
        ready = fs.exists(spark, schema_file) and (
            fs.exists(spark, plan_file) if scope == "dynamic" else fs.is_complete(spark, stage))
        if not ready:
            _clear_stage(spark, stage)
            continue
        schema = StructType.fromJson(json.loads(fs.read_text(spark, schema_file)))
        if scope == "dynamic":
            plan = json.loads(fs.read_text(spark, plan_file))
            _commit_partitions(spark, target, path, stage, plan, commit, schema)
        elif commit == "rename":
            _swap_in(spark, path, stage)
        else:
            _apply_stage(spark, target, path, scope, schema)
            _clear_stage(spark, stage)
        recovered = True
    return recovered


def _partitioned_schema(spark: SparkSession, target: TargetSpec, path: str, batch: DataFrame,
                        rels: list[str], merge: bool = False) -> StructType:
    """Schema of the given partition folders (``merge``: union of all their files' footers),
    with partition columns typed like the batch instead of inferred from folder names."""
    reader = spark.read.format(_format(target)).option("basePath", path)
    if merge:
        reader = reader.option("mergeSchema", "true")
    inferred = reader.load([f"{path}/{r}" for r in rels]).schema if rels else reader.load(path).schema
    return with_typed_partitions(inferred, batch.schema, list(target.partition_columns))


def _read_partitions(spark: SparkSession, target: TargetSpec, path: str, batch: DataFrame,
                     folders: list[str]) -> DataFrame:
    """The rows of the partitions about to be rewritten, under the merged schema of their
    files (a column present in only some files survives the rewrite)."""
    rels = [f[len(path) + 1:] for f in folders]
    schema = _partitioned_schema(spark, target, path, batch, rels, merge=True)
    if not folders:
        return literal_frame(spark, [], schema)
    return spark.read.format(_format(target)).schema(schema).option("basePath", path).load(folders)


def file_upsert(spark: SparkSession, df: DataFrame, target: TargetSpec, ctx: WriteContext) -> WriteReport:
    version = version_columns(target)
    if not version:
        return _file_upsert(spark, df, target, ctx, [])
    # read by every step of the upsert
    newest = newest_rows(df, list(target.merge_keys), version, target.null_safe_keys).persist()
    try:
        return _file_upsert(spark, newest, target, ctx, version)
    finally:
        newest.unpersist()


def _file_upsert(spark: SparkSession, df: DataFrame, target: TargetSpec, ctx: WriteContext,
                 version: list[str]) -> WriteReport:
    path = _path(target)
    keys = list(target.merge_keys)
    pcols = list(target.partition_columns)
    fmt = _format(target)
    scoped = rewrite_scope(target)
    recover_file_target(spark, target)
    if target.duplicate_keys == "error" and not ctx.keys_unique and not version:
        assert_unique_keys(df, keys, target.null_safe_keys)
    # absent, or partitioned with no partition yet (an empty batch was written): nothing to merge with
    if not fs.has_data(spark, path) or (pcols and not fs.partition_dirs(spark, path, len(pcols))):
        metrics = _save(df, target, path, "overwrite", pcols,
                        with_hash=bool(target.options.get("manifest_path")))
        return _report(spark, target, "merge", path, metrics, ctx, scope="create")
    var_keys = [k for k in keys if is_variable_width(df, k)]
    broadcast = should_broadcast(df, keys, ctx.batch_rows, ctx.broadcast_limit,
                                 ctx.var_key_bytes(var_keys) if var_keys else None) or bool(version) and few_keys(df, keys)
    touched = None
    with_hash = bool(target.options.get("manifest_path"))
    probe = bool(target.options.get("insert_probe", True))
    if not pcols:
        plain = spark.read.format(fmt).load(path)  # one listing, one footer's schema
        adds_columns = bool(set(df.columns) - set(plain.columns))
        matched = None
    elif scoped != "partitions":
        # files are found by their keys: no partition list is needed
        rels = fs.partition_dirs(spark, path, len(pcols))
        first = _partitioned_schema(spark, target, path, df, rels[:1])
        adds_columns = bool(set(df.columns) - set(first.fieldNames()))
        plain = spark.read.format(fmt).schema(first).load(path)
        wanted = [f"{path}/{rel}" for rel in rels]
        matched = None
    else:
        rels = fs.partition_dirs(spark, path, len(pcols))  # folders only, no file listing
        first = _partitioned_schema(spark, target, path, df, rels[:1])
        names = set(first.fieldNames())
        wanted = [f"{path}/{rel}" for rel in rels]
        adds_columns = bool(set(df.columns) - names)
        # a batch that adds columns rewrites everything, so no partition keeps the old schema
        if set(pcols) <= names and not adds_columns:
            if set(pcols) <= set(keys):
                # keys cannot change partition: only the batch's partition folders are read,
                # so the files of untouched partitions are never even listed
                touched = touched_partitions(df, pcols)
            else:
                # the key columns of every partition (one footer's schema is enough for them);
                # the same semi join tells whether any batch key exists at all
                keys_side = spark.read.format(fmt).schema(first).load(path)
                touched = touched_partitions(df, pcols, existing=keys_side, keys=keys,
                                             null_safe=target.null_safe_keys, broadcast_keys=broadcast)
            wanted = [w for w, rel in zip(wanted, rels) if _folder_values(rel) in touched.folder_values]
        matched = touched.any_match if touched is not None else None
        plain = (spark.read.format(fmt).schema(first).option("basePath", path).load(wanted) if wanted
                 else literal_frame(spark, [], first))
    if scoped == "marks":
        return _upsert_by_marks(spark, df, target, ctx, path, plain, broadcast, version)
    if scoped == "files" and not adds_columns:
        return _upsert_by_files(spark, df, target, ctx, path, plain, broadcast, version)
    if probe and not adds_columns:
        if matched is None:  # key columns only; stops at the first match
            matched = any_key_matches(plain, df, keys, target.null_safe_keys, broadcast)
        if not matched:
            # no batch key is in the target (an insert-only batch): append, rewrite nothing.
            # A replay after a crash finds its own rows and takes the merge path instead.
            # Columns the batch lacks are written as nulls: a file without them would hide them.
            lacking = [f for f in plain.schema.fields if f.name not in df.columns]
            filled = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking})
            metrics = _save(filled, target, path, "append", pcols, with_hash=with_hash)
            known = {} if touched is None else {PARTITIONS: (sorted(touched.folder_values), [])}
            return _report(spark, target, "merge", path, metrics, ctx, scope="insert", broadcast=broadcast, **known)
    # the rows to rewrite, under the merged schema of their files (a column present in only
    # some files survives); the files are rewritten anyway, so reading all footers costs little
    if not pcols:
        existing = spark.read.format(fmt).option("mergeSchema", "true").load(path)
    else:
        existing = _read_partitions(spark, target, path, df, wanted)
    scope = "static" if touched is None else "dynamic"
    combined = _merged(existing, df, target, broadcast, version)
    stage = _stage_path(path, scope)
    _clear_stage(spark, stage)
    fs.write_text(spark, stage + ".schema.json", combined.schema.json())
    commit = _commit_mode(spark, target, path)
    metrics = _save(combined, target, stage, "overwrite", pcols, with_hash=with_hash and commit == "rename")
    extra = {"scope": scope, "broadcast": broadcast, "commit": commit}
    if scope == "dynamic":
        plan = _partition_plan(spark, path, stage, len(pcols), touched)
        fs.write_text(spark, stage + ".plan.json", json.dumps(plan))  # the stage is now committed
        metrics = _commit_partitions(spark, target, path, stage, plan, commit, combined.schema) or metrics
        extra.update(replaced=len(plan["replace"]), removed=len(plan["remove"]))
        extra[PARTITIONS] = tuple([_folder_values(rel) for rel in plan[k]] for k in ("replace", "remove"))
    elif commit == "rename":
        _swap_in(spark, path, stage)
    else:
        metrics = _apply_stage(spark, target, path, scope, combined.schema)
        _clear_stage(spark, stage)
    return _report(spark, target, "merge", path, metrics, ctx, **extra)


def _merged(existing: DataFrame, df: DataFrame, target: TargetSpec, broadcast: bool, version: list[str]) -> DataFrame:
    """Target rows without the batch's keys, and the batch (or, by version, what is newer)."""
    keys, null_safe = list(target.merge_keys), target.null_safe_keys
    if version:
        return merge_by_version(existing, df, keys, version, null_safe, broadcast)
    return merge_plan(existing, df, keys, null_safe=null_safe, broadcast_keys=broadcast,
                      distinct_keys=target.duplicate_keys == "allow")


def _filled(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of the target that a frame lacks, as nulls: a file without them would hide them."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns})


def _upsert_by_files(spark: SparkSession, df: DataFrame, target: TargetSpec, ctx: WriteContext, path: str,
                     plain: DataFrame, broadcast: bool, version: list[str]) -> WriteReport:
    """Rewrite the files that hold a matched key; none: the batch is appended."""
    keys, pcols = list(target.merge_keys), list(target.partition_columns)
    with_hash = bool(target.options.get("manifest_path"))
    files = rewrite.touched_files(spark, path, plain, df, keys, target.null_safe_keys, broadcast)
    if not files:
        metrics = _save(_filled(df, plain.schema), target, path, "append", pcols, with_hash=with_hash)
        return _report(spark, target, "merge", path, metrics, ctx, scope="insert", broadcast=broadcast)
    reader = spark.read.format(_format(target)).option("basePath", path).option("mergeSchema", "true")
    existing = reader.load([f"{path}/{f}" for f in files])
    if pcols:
        existing = (spark.read.format(_format(target)).option("basePath", path)
                    .schema(with_typed_partitions(existing.schema, df.schema, pcols)).load([f"{path}/{f}" for f in files]))
    combined = _filled(_merged(existing, df, target, broadcast, version), plain.schema)
    metrics = _save(combined, target, f"{rewrite.stage_path(path)}/data", "overwrite", pcols, with_hash=with_hash)
    plan = rewrite.write_plan(spark, path, files)
    rewrite.apply_plan(spark, path, plan)
    extra = {}
    if pcols:
        folders = [sorted({rel.rpartition("/")[0] for rel in rels}) for rels in ([dst for _, dst in plan["add"]], files)]
        gone = [rel for rel in folders[1] if not fs.exists(spark, f"{path}/{rel}")]
        extra[PARTITIONS] = ([_folder_values(rel) for rel in folders[0]], [_folder_values(rel) for rel in gone])
    return _report(spark, target, "merge", path, metrics, ctx, scope="files", broadcast=broadcast, replaced=len(files), **extra)


def _upsert_by_marks(spark: SparkSession, df: DataFrame, target: TargetSpec, ctx: WriteContext, path: str,
                     plain: DataFrame, broadcast: bool, version: list[str]) -> WriteReport:
    """Mark the matched rows as gone and add the batch as new files."""
    keys, pcols, null_safe = list(target.merge_keys), list(target.partition_columns), target.null_safe_keys
    stage = rewrite.stage_path(path)
    if version:
        live = rewrite.without_marked(spark, path, rewrite.in_key_range(plain, df, keys, null_safe),
                                      rewrite.mark_commits(spark, path)).drop(rewrite.FILE, rewrite.ROW)
        added = newest_rows(df, keys, version, null_safe, live, broadcast)
    else:
        added = df
    metrics = _save(_filled(added, plain.schema), target, f"{stage}/data", "overwrite", pcols,
                    with_hash=bool(target.options.get("manifest_path")))
    gone = rewrite.matched_positions(spark, path, plain, df, keys, null_safe, broadcast)
    gone, obs = observed(gone, False)
    gone.write.mode("overwrite").parquet(f"{stage}/marks")
    rewrite.apply_plan(spark, path, rewrite.write_plan(spark, path, [], marks=True))
    return _report(spark, target, "merge", path, metrics, ctx, scope="marks", broadcast=broadcast,
                   marked=observed_metrics(obs)["rows"])


def compact_marks(spark: SparkSession, target: TargetSpec) -> int:
    """Rewrite the files that hold marked rows without them, and drop the marks. Returns how
    many files were rewritten; the others are not read."""
    path, pcols = _path(target), list(target.partition_columns)
    recover_file_target(spark, target)
    commits = rewrite.mark_commits(spark, path)
    named = {r[rewrite.FILE] for r in rewrite.marks_frame(spark, path, commits).select(rewrite.FILE).distinct().collect()}
    files = sorted(f for f in named if fs.exists(spark, f"{path}/{f}"))
    if files:
        held = (spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*[f"{path}/{f}" for f in files]))
        columns = [F.col(f"`{c}`") for c in held.columns]
        live = rewrite.without_marked(spark, path, held, commits).select(*columns)
        _save(live, target, f"{rewrite.stage_path(path)}/data", "overwrite", pcols)
    if commits:
        rewrite.apply_plan(spark, path, rewrite.write_plan(spark, path, files, drop_marks=commits))
    return len(files)


def read_file_target(spark: SparkSession, target: TargetSpec, schema: StructType | None = None) -> DataFrame:
    if rewrite_scope(target) == "marks":
        return rewrite.read_live(spark, _path(target), schema)
    reader = spark.read.format(_format(target))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(_path(target))
