"""Upserts that rewrite, or mark, only the files holding a matched key.

``rewrite: files`` — a semi join of the target's key columns and ``_metadata.file_path`` with
the batch's keys finds the files with a matched key (the batch's key range is pushed to the
scan first, so row groups outside it are not read); only those are read, merged with the batch
and replaced.

``rewrite: marks`` (Parquet) — merge on read: no file is rewritten. The positions
(``_metadata.row_index``) of matched rows are written beside the data, under
``<path>__deleted/commit=<id>``, and the batch is added as new files, so an upsert writes in
proportion to its batch. ``read_live`` leaves marked rows out; ``compact_marks`` rewrites the
files that hold them.

Both are committed by a list of file moves written before the first of them
(``<path>__stage_files.plan.json``). Every move can be repeated, so the next run on the target
finishes an interrupted list; a stage without one is discarded. While a list that replaces files
is under way, a reader may miss their rows, as with the partition-scoped commit. An upsert with
marks replaces none: ``read_live`` shows the target as before until all of its list is done.
"""
from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DateType, IntegerType, LongType, ShortType, StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)

from .. import fs
from ..functions import literal_frame
from ..operators.upsert import DEFAULT_BROADCAST_LIMIT

#: Key types whose range is pushed to the scan.
RANGED = (ByteType, ShortType, IntegerType, LongType, DateType, TimestampType, TimestampNTZType)
FILE, ROW = "__file", "__row"
MARKS_SCHEMA = StructType([StructField(FILE, StringType()), StructField(ROW, LongType())])


def stage_path(path: str) -> str:
    return f"{path}__stage_files"


def marks_path(path: str) -> str:
    return f"{path}__deleted"


def _plan_file(path: str) -> str:
    return stage_path(path) + ".plan.json"


def _key_rows(batch: DataFrame, keys: list[str], broadcast: bool) -> DataFrame:
    rows = batch.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)])
    return F.broadcast(rows) if broadcast else rows


def _same(existing: DataFrame, rows: DataFrame, keys: list[str], null_safe: bool) -> Column:
    conds = [existing[f"`{k}`"].eqNullSafe(rows[f"__k{i}"]) if null_safe else existing[f"`{k}`"] == rows[f"__k{i}"]
             for i, k in enumerate(keys)]
    return reduce(lambda a, b: a & b, conds)


def in_key_range(existing: DataFrame, batch: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """Target rows within the batch's range of each integral or time key: a pushed filter."""
    ranged = [k for k in keys if isinstance(batch.schema[k].dataType, RANGED)
              and existing.schema[k].dataType == batch.schema[k].dataType]
    if null_safe or not ranged:  # a null key has no range
        return existing
    ends = [f(F.col(f"`{k}`")).alias(f"{n}{i}") for i, k in enumerate(ranged) for n, f in (("lo", F.min), ("hi", F.max))]
    row = batch.agg(*ends).first()
    for i, k in enumerate(ranged):
        if row[f"lo{i}"] is None:
            return existing.filter(F.lit(False))
        existing = existing.filter(F.col(f"`{k}`").between(F.lit(row[f"lo{i}"]), F.lit(row[f"hi{i}"])))
    return existing


def _inner_path(spark: SparkSession, path: str) -> str:
    """The path without scheme and authority, as ``_metadata.file_path`` is compared."""
    hfs, hpath = fs._fs(spark, path)
    return str(hfs.makeQualified(hpath).toUri().getPath()).rstrip("/")


def relative_file(spark: SparkSession, path: str) -> Column:
    """The scanned file's path below the target. The metadata holds it as a URI, in which what a
    path may not hold is escaped (the ``%`` of an escaped partition value too)."""
    root = _inner_path(spark, path)
    inner = F.regexp_replace(F.col("_metadata.file_path"), r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    plain = F.url_decode(F.replace(inner, F.lit("+"), F.lit("%2B")))  # a plus is a plus in a path
    return F.substring(plain, len(root) + 2, 1 << 30)


def touched_files(spark: SparkSession, path: str, existing: DataFrame, batch: DataFrame, keys: list[str],
                  null_safe: bool = False, broadcast: bool = False) -> list[str]:
    """Files (below the target) that hold a key of the batch. One path per file reaches the
    driver, which lists the target's files anyway."""
    rows = in_key_range(existing, batch, keys, null_safe)
    found = rows.select(*[F.col(f"`{k}`") for k in keys], F.col("_metadata.file_path").alias("__uri"),
                        relative_file(spark, path).alias(FILE))
    right = _key_rows(batch, keys, broadcast)
    hit = found.join(right, _same(found, right, keys, null_safe), "left_semi").select(FILE).distinct()
    return sorted(r[FILE] for r in hit.collect())


# ------------------------------------------------------------------ the list of moves

def _staged_files(spark: SparkSession, folder: str) -> list[str]:
    """Data files below a folder, by relative path."""
    out: list[str] = []
    hfs, hpath = fs._fs(spark, folder)
    if not hfs.exists(hpath):
        return out
    files = hfs.listFiles(hpath, True)
    root = _inner_path(spark, folder)
    while files.hasNext():
        rel = str(files.next().getPath().toUri().getPath())[len(root) + 1:]
        if not rel.rsplit("/", 1)[-1].startswith(("_", ".")):
            out.append(rel)
    return sorted(out)


def _fresh(rel: str, mark: str) -> str:
    """A file name no earlier commit has used."""
    folder, _, name = rel.rpartition("/")
    return f"{folder}/{mark}-{name}" if folder else f"{mark}-{name}"


def write_plan(spark: SparkSession, path: str, remove: list[str], marks: bool = False,
               drop_marks: list[str] | None = None) -> dict:
    """The commit's moves: staged data files in, replaced files out, staged marks in, merged
    marks out. Writing the list is what commits the stage."""
    commit = uuid.uuid4().hex
    plan = {"commit": commit, "remove": remove, "marks": marks, "drop_marks": drop_marks or [],
            "add": [[rel, _fresh(rel, commit[:12])] for rel in _staged_files(spark, f"{stage_path(path)}/data")]}
    fs.write_text(spark, _plan_file(path), json.dumps(plan))
    return plan


def read_plan(spark: SparkSession, path: str) -> dict | None:
    return json.loads(fs.read_text(spark, _plan_file(path))) if fs.exists(spark, _plan_file(path)) else None


def _move(spark: SparkSession, src: str, dst: str) -> None:
    if fs.exists(spark, src):
        fs.mkdirs(spark, dst.rsplit("/", 1)[0])
        fs.rename(spark, src, dst)


def apply_plan(spark: SparkSession, path: str, plan: dict) -> None:
    """All moves of a list; those already made are left out. The list goes last."""
    stage = stage_path(path)
    for rel in plan["remove"]:
        fs.delete(spark, f"{path}/{rel}")
    for src, dst in plan["add"]:
        _move(spark, f"{stage}/data/{src}", f"{path}/{dst}")
    if plan["marks"]:
        _move(spark, f"{stage}/marks", f"{marks_path(path)}/commit={plan['commit']}")
    for name in plan["drop_marks"]:
        fs.delete(spark, f"{marks_path(path)}/{name}")
    for folder in sorted({rel.rpartition("/")[0] for rel in plan["remove"]}, reverse=True):
        if folder and not fs.has_data(spark, f"{path}/{folder}"):
            fs.delete(spark, f"{path}/{folder}")  # a partition all of whose rows have moved
    fs.delete(spark, stage)
    fs.delete(spark, _plan_file(path))
    spark.catalog.refreshByPath(path)


def recover(spark: SparkSession, path: str) -> bool:
    """Finish an interrupted list of moves; a stage without a list is discarded."""
    plan = read_plan(spark, path)
    if plan is None:
        fs.delete(spark, stage_path(path))
        return False
    apply_plan(spark, path, plan)
    return True


# ------------------------------------------------------------------ marked rows

def mark_commits(spark: SparkSession, path: str, pending: dict | None = None) -> list[str]:
    """Folders of marks in force: all but those of a list still under way."""
    names = [n for n in fs.list_names(spark, marks_path(path)) if n.startswith("commit=")]
    return [n for n in names if pending is None or n != f"commit={pending['commit']}"]


def marks_frame(spark: SparkSession, path: str, commits: list[str]) -> DataFrame:
    if not commits:
        return literal_frame(spark, [], MARKS_SCHEMA)
    return spark.read.schema(MARKS_SCHEMA).parquet(*[f"{marks_path(path)}/{c}" for c in commits])


def without_marked(spark: SparkSession, path: str, rows: DataFrame, commits: list[str],
                   limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Rows of a scan, with their FILE and ROW, that no mark hides. Marks are broadcast only
    below a measured size; beyond it the join is by file and position, which adaptive
    execution splits where one file has very many."""
    placed = rows.select("*", relative_file(spark, path).alias(FILE), F.col("_metadata.row_index").alias(ROW))
    if not commits:
        return placed
    marks = marks_frame(spark, path, commits).distinct().select(F.col(FILE).alias("__mf"), F.col(ROW).alias("__mr"))
    # a count from footers; a mark takes its path and position
    if marks_frame(spark, path, commits).count() * 200 <= limit:
        marks = F.broadcast(marks)
    return placed.join(marks, (placed[FILE] == marks["__mf"]) & (placed[ROW] == marks["__mr"]), "left_anti")


def read_live(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The rows of a target with marks; a list of moves under way does not show."""
    pending = read_plan(spark, path)
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    plain = reader.parquet(path)
    rows = without_marked(spark, path, plain, mark_commits(spark, path, pending))
    if pending and pending["add"]:
        new = literal_frame(spark, [(dst,) for _, dst in pending["add"]], StructType([StructField("__new", StringType())]))
        rows = rows.join(F.broadcast(new), rows[FILE] == new["__new"], "left_anti")
    return rows.select(*[F.col(f"`{c}`") for c in plain.columns])


def matched_positions(spark: SparkSession, path: str, existing: DataFrame, batch: DataFrame, keys: list[str],
                      null_safe: bool = False, broadcast: bool = False) -> DataFrame:
    """FILE and ROW of the live rows whose key is in the batch."""
    live = without_marked(spark, path, in_key_range(existing, batch, keys, null_safe)
                          .select(*[F.col(f"`{k}`") for k in keys], "_metadata"), mark_commits(spark, path))
    right = _key_rows(batch, keys, broadcast)
    return live.join(right, _same(live, right, keys, null_safe), "left_semi").select(FILE, ROW)
