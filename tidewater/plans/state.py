"""Incremental state, run audit and run metrics as small append-only Parquet tables,
each partitioned by dataset.

State rows: ``(dataset, target, column, type, value, batch_id, updated_at)``. The value
is text rendered by Spark from the typed column (see ``functions.typed``), so it parses
back to the same value in any session time zone. Each target has its own row stream:
a target that did not load a batch keeps its own watermark. The latest row per
``(dataset, target)`` by ``batch_id`` wins.

Every commit writes a folder of its own, ``dataset=<name>/commit=<id>``, straight from its own
job: runs of other datasets, or of the same one, share no temporary folder, so any number of
them may commit at once. Readers take one dataset's folders only. Every ``COMPACT_EVERY``
batches a dataset's latest state rows are written as one more commit and the commits they
came from are removed afterwards; a crash in between leaves rows twice, which "latest wins"
reads alike. Audit and metric rows are history and never rewritten.
"""
from __future__ import annotations

import datetime as _dt
import re
import uuid
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, LongType, StringType, StructField, StructType,
                               TimestampType)

from .. import fs
from ..errors import SpecError
from ..functions import literal_frame

# Fixed value: batches between compactions of a dataset's state and history.
COMPACT_EVERY = 100
# Mark of a commit that stands for others; how often a read is tried.
TOGETHER = "t-"
READS = 5

STATE_SCHEMA = StructType([
    StructField("dataset", StringType(), False),
    StructField("target", StringType(), False),
    StructField("column", StringType(), True),
    StructField("type", StringType(), True),
    StructField("value", StringType(), True),
    StructField("batch_id", LongType(), False),
    StructField("updated_at", TimestampType(), False),
])

AUDIT_SCHEMA = StructType([
    StructField("run_id", StringType(), False),
    StructField("dataset", StringType(), False),
    StructField("target", StringType(), True),
    StructField("batch_id", LongType(), True),
    StructField("row_count", LongType(), False),
    StructField("rows_written", LongType(), True),
    StructField("dq_passed", BooleanType(), False),
    StructField("violations", StringType(), True),
    StructField("watermark", StringType(), True),
    StructField("started_at", TimestampType(), False),
    StructField("finished_at", TimestampType(), False),
])

METRIC_SCHEMA = StructType([
    StructField("run_id", StringType(), False),
    StructField("dataset", StringType(), False),
    StructField("metric", StringType(), False),
    StructField("value", DoubleType(), False),
    StructField("recorded_at", TimestampType(), False),
])


@dataclass(frozen=True)
class StateEntry:
    target: str
    column: str | None
    type: str | None
    value: str | None
    batch_id: int
    # when the run that wrote the entry began; set by read_state
    updated_at: _dt.datetime | None = None

    @property
    def watermark(self) -> tuple[str, str] | None:
        if self.value is None or self.type is None:
            return None
        return self.value, self.type


def _durable_root(spark: SparkSession, what: str) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise SpecError(f"{what} is not set and spark.checkpoint.dir names no shared folder; "
                        f"state kept elsewhere would be forgotten with the session")
    return root.rstrip("/")


def default_state_path(spark: SparkSession) -> str:
    return f"{_durable_root(spark, 'state_path')}/tidewater_state"


def default_audit_path(spark: SparkSession) -> str:
    return f"{_durable_root(spark, 'audit_path')}/tidewater_audit"


def _dataset_dir(path: str, dataset: str) -> str:
    return f"{path}/dataset={quote(dataset, safe='')}"


def _append(spark: SparkSession, path: str, dataset: str, rows: DataFrame, kind: str = "") -> str:
    """One commit: a folder no other job writes to, with one file. Returns its name."""
    name = f"commit={kind}{uuid.uuid4().hex}"
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{_dataset_dir(path, dataset)}/{name}")
    return name


def _log_frame(spark: SparkSession, path: str, schema: StructType, dataset: str | None = None) -> DataFrame:
    """Rows of all commits (of one dataset)."""
    folder = path if dataset is None else _dataset_dir(path, dataset)
    if not fs.has_data(spark, folder):
        return literal_frame(spark, [], schema)
    return spark.read.schema(schema).parquet(folder).select(*schema.fieldNames())


def state_frame(spark: SparkSession, path: str, dataset: str | None = None) -> DataFrame:
    return _log_frame(spark, path, STATE_SCHEMA, dataset)


def latest_state(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Latest state row per target of a dataset."""
    rows = state_frame(spark, path, dataset)
    best = F.max_by(F.struct("column", "type", "value", "batch_id", "updated_at"),
                    F.struct("batch_id", "updated_at")).alias("s")
    return rows.groupBy("dataset", "target").agg(best).select("dataset", "target", "s.*")


def read_state(spark: SparkSession, path: str, dataset: str, targets: list[str]) -> dict[str, StateEntry]:
    """Latest entry of each named target (bounded: one row per target)."""
    if not fs.exists(spark, path):
        return {}
    for left in reversed(range(READS)):
        try:
            rows = (latest_state(spark, path, dataset).filter(F.col("target").isin(targets))
                    .withColumn("began", F.unix_micros("updated_at")).collect())
            break
        except Exception as failed:  # a commit went between its listing and its read
            if not left or not re.search("FILE_NOT_EXIST|FileNotFound|PATH_NOT_FOUND", str(failed)):
                raise
            spark.catalog.refreshByPath(_dataset_dir(path, dataset))
    return {r["target"]: StateEntry(r["target"], r["column"], r["type"], r["value"], int(r["batch_id"]),
                                    _dt.datetime.fromtimestamp(int(r["began"]) / 1e6, _dt.timezone.utc)) for r in rows}


def commit_state(spark: SparkSession, path: str, dataset: str, entries: list[StateEntry],
                 now: _dt.datetime | None = None) -> None:
    """Append one row per target; called only after that target's write succeeded."""
    if not entries:
        return
    when = now or _dt.datetime.now(_dt.timezone.utc)
    rows = [(dataset, e.target, e.column, e.type, e.value, int(e.batch_id), when) for e in entries]
    _append(spark, path, dataset, literal_frame(spark, rows, STATE_SCHEMA))
    if any(e.batch_id % COMPACT_EVERY == 0 for e in entries):
        compact_state(spark, path, dataset)


def _compact(spark: SparkSession, path: str, dataset: str, schema: StructType, latest: bool) -> bool:
    """One commit in place of those since the last time, which are removed when it is there."""
    folder = _dataset_dir(path, dataset)
    # history that was put together stays as it is; the latest state takes its forerunner in
    single = [n for n in fs.list_names(spark, folder)
              if n.startswith("commit=") and (latest or not n.startswith(f"commit={TOGETHER}"))]
    if len(single) < 2:
        return False
    rows = spark.read.schema(schema).parquet(*[f"{folder}/{n}" for n in single])
    if latest:
        best = F.max_by(F.struct("column", "type", "value", "batch_id", "updated_at"),
                        F.struct("batch_id", "updated_at")).alias("s")
        rows = rows.groupBy("dataset", "target").agg(best).select("dataset", "target", "s.*")
    _append(spark, path, dataset, rows.select(*schema.fieldNames()).distinct(), TOGETHER)
    for name in single:
        fs.delete(spark, f"{folder}/{name}")
    return True


def compact_state(spark: SparkSession, path: str, dataset: str) -> None:
    """Write the latest row per target as one commit in place of those it came from."""
    _compact(spark, path, dataset, STATE_SCHEMA, latest=True)


def compact_history(spark: SparkSession, path: str, dataset: str) -> None:
    """Put a dataset's audit and metric rows since the last time together, each in one file."""
    for part, schema in (("runs", AUDIT_SCHEMA), ("metrics", METRIC_SCHEMA)):
        if fs.exists(spark, _dataset_dir(f"{path}/{part}", dataset)):
            _compact(spark, f"{path}/{part}", dataset, schema, latest=False)


def _append_rows(spark: SparkSession, path: str, rows: list[tuple], schema: StructType) -> None:
    for dataset in sorted({r[1] for r in rows}):
        _append(spark, path, dataset, literal_frame(spark, [r for r in rows if r[1] == dataset], schema))


def append_audit(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    _append_rows(spark, f"{path}/runs", rows, AUDIT_SCHEMA)


def append_metrics(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    _append_rows(spark, f"{path}/metrics", rows, METRIC_SCHEMA)


def audit_frame(spark: SparkSession, path: str) -> DataFrame:
    return _log_frame(spark, f"{path}/runs", AUDIT_SCHEMA).distinct()


def metrics_frame(spark: SparkSession, path: str) -> DataFrame:
    return _log_frame(spark, f"{path}/metrics", METRIC_SCHEMA).distinct()
