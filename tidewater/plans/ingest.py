"""Spec-driven ingestion run:

    recover staged commits → read state → scan (+ typed watermark filter, pushed down)
    → transforms → [keep the batch] → one-pass profile → quality gate (→ quarantine)
    → write every target → advance each target's state → audit

The batch is kept (executor cache, or a reliable checkpoint for sources whose re-read is
not reproducible) when it would otherwise be computed more than once at a cost: a
shuffle in the transforms, several targets, row quarantine, or a JDBC/Kafka source. A
single narrow target rescans instead (a column-pruned profile, then one full read).

Spark jobs per run: the profile, then one write job per target (row count and checksum
are observed during the write, not counted again), plus tiny state/audit appends.
"""
from __future__ import annotations

import datetime as _dt
import logging
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..errors import DataQualityError, DuplicateMergeKeyError, SpecError
from ..functions import typed
from ..operators.chain import TransformFn, apply_chain, compile_chain, is_wide
from ..operators.quality import BAD_ROWS, ROWS, WM_MAX, QualityResult, bytes_alias, evaluate, run_profile
from ..operators.quarantine import (REASON, annotate_rows, good_rows, quarantine_batch, quarantine_rows,
                                    quarantine_unparsed)
from ..operators.upsert import is_variable_width
from ..sinks import WriteContext, WriteReport, recover_target, write_target
from ..session import work_dir
from ..sources import read_source
from ..sources.parsing import RAW, UNPARSED, split_unparsed, wants_quarantine
from ..spec import DatasetSpec, RetrySpec, TargetSpec
from . import state as st
from .locks import target_locks

log = logging.getLogger("tidewater.run")

WM = "__wm"
LATE = "__late"
# Sources whose second read may return other rows (live database, topic).
UNREPRODUCIBLE_SOURCES = ("jdbc", "kafka")
# Transforms that leave every remaining value and the row count as they are.
KEEPS_KEYS = ("add_metadata", "drop")

# Metric names.
METRIC_ROWS = "ingestion.row_count"
METRIC_VIOLATIONS = "ingestion.dq_violations"
METRIC_QUARANTINED = "ingestion.quarantined_rows"
METRIC_UNPARSED = "ingestion.unparsed_records"


@dataclass
class RunResult:
    run_id: str
    dataset_name: str
    row_count: int
    quality: QualityResult | None = None
    targets_written: list[str] = field(default_factory=list)
    reports: list[WriteReport] = field(default_factory=list)
    watermark: str | None = None
    skipped: bool = False
    quarantine_path: str | None = None


def select_targets(spec: DatasetSpec, targets: list[str] | None) -> list[TargetSpec]:
    """All targets, or those named by id (else by type); none left is an error."""
    if targets is None:
        return list(spec.targets)
    wanted = set(targets)
    chosen = [t for t in spec.targets if t.id in wanted]
    if not chosen:
        chosen = [t for t in spec.targets if t.type in wanted]
    if not chosen:
        raise SpecError(f"no targets of {spec.dataset_name!r} match {sorted(wanted)}")
    return chosen


def _keys_unique(spec: DatasetSpec, target: TargetSpec) -> bool:
    """The batch is known to be unique on the merge keys when a dedup on a subset of them is
    followed only by transforms that neither change a value nor add a row."""
    for t in reversed(spec.transforms):
        if t.type == "deduplicate":
            return set(t.params.get("keys", [])) <= set(target.merge_keys)
        if t.type not in KEEPS_KEYS:
            return False
    return False


def replay_safe(target: TargetSpec) -> bool:
    """Writing the batch again replaces it: merges, overwrites and appends keyed by batch."""
    return target.is_merge or target.write_mode == "overwrite" or target.idempotent


def _waits(retry: RetrySpec) -> Iterator[float]:
    """Seconds before each further attempt."""
    return (min(retry.initial_delay_seconds * retry.backoff_multiplier ** i, retry.max_delay_seconds)
            for i in range(max(1, retry.max_attempts) - 1))


def write_with_retry(spark: SparkSession, df: DataFrame, target: TargetSpec, ctx: WriteContext,
                     retry: RetrySpec) -> WriteReport:
    """A failed write is tried again only if it is replay safe and the error is one that
    may pass (spec, analysis and duplicate-key errors recur). Task retries are Spark's."""
    waits = _waits(retry) if replay_safe(target) else iter(())
    while True:
        try:
            return write_target(spark, df, target, ctx)
        except (SpecError, DuplicateMergeKeyError, AnalysisException):
            raise
        except Exception:
            wait = next(waits, None)
            if wait is None:
                raise
            time.sleep(wait)


def _past_any(first: Column, tie: Column | None, marks: list[tuple[str, str]], inclusive: bool) -> Column:
    """Is a row past the least of the marks?"""
    if tie is None and len({t for _, t in marks}) == 1 and not marks[0][1].startswith("struct<"):
        parsed = [typed.parse(v, t) for v, t in marks]
        bound = parsed[0] if len(parsed) == 1 else F.least(*parsed)
        return first >= bound if inclusive else first > bound
    return reduce(lambda a, b: a | b, [typed.past(first, tie, m, inclusive) for m in dict.fromkeys(marks)])


def _advanced(spark: SparkSession, new: str, new_type: str, olds: dict[str, tuple[str, str]]) -> dict[str, bool]:
    """For each target, is the batch maximum past its stored mark? (constants only)"""
    if not olds:
        return {}
    exprs = [typed.newer((new, new_type), old).alias(f"t{i}") for i, old in enumerate(olds.values())]
    row = spark.range(1).select(*exprs).first()
    return {k: bool(row[f"t{i}"]) for i, k in enumerate(olds)}


def storage_for(spec: DatasetSpec) -> str:
    if spec.batch_storage != "auto":
        return spec.batch_storage
    return "checkpoint" if spec.source.type in UNREPRODUCIBLE_SOURCES else "cache"


@dataclass
class PreparedBatch:
    """The lazy, transformed batch of a run and what the run knows before acting on it."""
    df: DataFrame
    selected: list[TargetSpec]
    states: dict
    marks: dict
    wm_type: str | None
    extract_obs: Observation | None
    state_path: str
    unparsed: DataFrame | None = None


def _late_rows(rows: DataFrame, spec: DatasetSpec, states: list[st.StateEntry], past: Callable[[DataFrame], Column]) -> DataFrame | None:
    """Rows not past the mark in files written since the earliest of the targets' last runs began. The
    condition on the files' times is one on the scan's file list, so other files are not opened."""
    if spec.source.late_rows != "new_files" or any(s.updated_at is None for s in states):
        return None
    since = min(s.updated_at for s in states) - _dt.timedelta(seconds=spec.source.late_margin_seconds)
    written = F.timestamp_micros(F.lit(int(since.timestamp() * 1e6)))
    return rows.filter(F.col("_metadata.file_modification_time") >= written).filter(~F.coalesce(past(rows), F.lit(False)))


def prepare_batch(spark: SparkSession, spec: DatasetSpec, *, targets: list[str] | None = None,
                  transforms: list[TransformFn] | None = None,
                  run_time: _dt.datetime | None = None, recover: bool = True) -> PreparedBatch:
    """Read state and build the batch's plan (incremental filter, transforms) without
    running it — ``prepare_batch(...).df.explain()`` shows what a run would execute."""
    run_time = run_time or _dt.datetime.now(_dt.timezone.utc)
    selected = select_targets(spec, targets)
    state_path = spec.state_path or st.default_state_path(spark)
    if recover:
        for t in selected:
            recover_target(spark, t)
    states = st.read_state(spark, state_path, spec.dataset_name, [t.id for t in selected])

    wm_col, tie_col = spec.source.watermark_column, spec.source.watermark_tie_column
    marks = {t.id: states[t.id].watermark for t in selected
             if t.id in states and states[t.id].watermark is not None}
    df, unparsed = read_source(spark, spec.source), None
    if wants_quarantine(spec.source):
        df, unparsed = split_unparsed(df)
    if wm_col and marks and len(marks) == len(selected):
        # The least mark over the targets; rows each target already has are cut below.
        def past(rows: DataFrame) -> Column:
            return _past_any(rows[wm_col], rows[tie_col] if tie_col else None, list(marks.values()),
                             spec.source.watermark_overlap)

        late = _late_rows(df, spec, [states[t.id] for t in selected], past)
        df = df.filter(past(df))
        if late is not None:
            df = df.withColumn(LATE, F.lit(False)).unionByName(late.withColumn(LATE, F.lit(True)))
        if unparsed is not None:  # a failed record without a mark is taken each time it is read
            unparsed = unparsed.filter(F.coalesce(past(unparsed), unparsed[wm_col].isNull()))
    if wm_col:
        df = df.withColumn(WM, typed.mark_value(wm_col, tie_col))
    wm_type = df.schema[WM].dataType.simpleString() if wm_col else None
    extract_obs = None
    if wm_col and transforms:
        extract_obs = Observation()
        df = df.observe(extract_obs, typed.render(F.max(F.col(WM)), df.schema[WM].dataType).alias("wm"))
    fns = compile_chain(spec.transforms, spec.dataset_name, run_time) + list(transforms or [])
    return PreparedBatch(apply_chain(df, fns), selected, states, marks, wm_type, extract_obs, state_path, unparsed)


def run(spark: SparkSession, spec: DatasetSpec, *, targets: list[str] | None = None,
        transforms: list[TransformFn] | None = None, run_time: _dt.datetime | None = None,
        run_id: str | None = None) -> RunResult:
    """Run one dataset spec once.

    ``targets`` restricts the run to targets named by id (or, failing that, by type);
    each keeps its own watermark, so targets run at different times each get exactly the
    rows they have not loaded. ``transforms`` are extra ``DataFrame -> DataFrame``
    functions applied after the spec's own. ``run_time`` fixes ``_ingested_at``.

    Raises ``DataQualityError`` when the gate fails and the spec says so (after the batch
    quarantine, if configured); no target is written and no state advances then. A run that
    finds one of its targets held by another run waits for it (see ``locks``).
    """
    run_time = run_time or _dt.datetime.now(_dt.timezone.utc)
    run_id = run_id or uuid.uuid4().hex
    names = [t.id for t in select_targets(spec, targets)]
    with target_locks(spark, spec.state_path or st.default_state_path(spark), spec.dataset_name, names, run_id):
        return _run(spark, spec, names, transforms, run_time, run_id)


def _run(spark: SparkSession, spec: DatasetSpec, targets: list[str], transforms: list[TransformFn] | None,
         run_time: _dt.datetime, run_id: str) -> RunResult:
    b = prepare_batch(spark, spec, targets=targets, transforms=transforms, run_time=run_time)
    if len({b.marks.get(t.id) for t in b.selected}) > 1 and (is_wide(spec.transforms) or transforms):
        # a dedup over the rows of the furthest-behind target may keep a row that another
        # target already has and drop the one it lacks: each distinct mark is a run of its own
        parts = [_run(spark, spec, [t.id for t in b.selected if b.marks.get(t.id) == mark], transforms, run_time, run_id)
                 for mark in dict.fromkeys(b.marks.get(t.id) for t in b.selected)]
        return _joined(parts)
    return process_batch(
        spark, spec, b.df, b.selected, run_id=run_id, run_time=run_time,
        # persist when a shuffle would otherwise rerun, or when several targets would
        # each rescan the source; a single narrow target just rescans (column-pruned
        # profile + one full read), which keeps executor storage free
        persist=(is_wide(spec.transforms) or bool(transforms) or len(b.selected) > 1
                 or storage_for(spec) == "checkpoint"),
        states=b.states, marks=b.marks, wm_type=b.wm_type, extract_obs=b.extract_obs,
        state_path=b.state_path, extra_transforms=bool(transforms), unparsed=b.unparsed)


def _joined(parts: list[RunResult]) -> RunResult:
    """One result for the runs of several marks: the largest batch, everything written."""
    largest = max(parts, key=lambda r: r.row_count)
    return RunResult(largest.run_id, largest.dataset_name, largest.row_count, largest.quality,
                     [t for r in parts for t in r.targets_written], [w for r in parts for w in r.reports],
                     largest.watermark, all(r.skipped for r in parts),
                     next((r.quarantine_path for r in parts if r.quarantine_path), None))


def process_batch(spark: SparkSession, spec: DatasetSpec, df: DataFrame, selected: list[TargetSpec], *,
                  run_id: str, run_time: _dt.datetime, persist: bool,
                  states: dict[str, st.StateEntry] | None = None,
                  marks: dict[str, tuple[str, str]] | None = None, wm_type: str | None = None,
                  extract_obs: Observation | None = None, state_path: str | None = None,
                  batch_id: int | None = None, extra_transforms: bool = False,
                  unparsed: DataFrame | None = None) -> RunResult:
    """Profile, gate, quarantine, write and commit one transformed batch. Shared by the
    batch run and the streaming ``foreachBatch``."""
    states = states or {}
    marks = marks or {}
    dq = spec.data_quality
    audit_path = spec.audit_path or st.default_audit_path(spark)
    q = spec.quarantine
    rows_mode = q is not None and q.mode == "rows"
    if rows_mode:
        df = annotate_rows(df, q.not_null, q.rules)
        persist = True
    checkpointed = persist and storage_for(spec) == "checkpoint"
    if checkpointed:
        # reliable checkpoint into the shared spark.checkpoint.dir: lineage is cut, so a
        # lost executor re-reads these files instead of re-querying the source
        work_dir(spark)
        df = df.checkpoint(eager=True)
        persist = False
    elif persist:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    started = _dt.datetime.now(_dt.timezone.utc)
    try:
        has_wm = WM in df.columns
        size_cols = sorted({k for t in selected if t.is_merge for k in t.merge_keys
                            if k in df.columns and is_variable_width(df, k)})
        profile = run_profile(df, dq, WM if has_wm else None, REASON if rows_mode else None, size_cols)
        column_bytes = {c: int(profile.get(bytes_alias(c)) or 0) for c in size_cols}
        visible = df.drop(WM, REASON, LATE)
        result = evaluate(visible, profile, dq, spec.source.schema)
        rows = int(profile.get(ROWS) or 0)
        new_wm = profile.get(WM_MAX) if has_wm else None
        if new_wm is None and extract_obs is not None and not has_wm:
            new_wm = (extract_obs.get or {}).get("wm")  # a custom transform dropped the column
        metrics = [(run_id, spec.dataset_name, METRIC_ROWS, float(rows), started)]
        out = RunResult(run_id, spec.dataset_name, rows, result, watermark=new_wm)

        if unparsed is not None:
            where, failed = quarantine_unparsed(unparsed, q.path, spec.dataset_name, RAW, UNPARSED)
            metrics.append((run_id, spec.dataset_name, METRIC_UNPARSED, float(failed), started))
            out.quarantine_path = where if failed else None
        if rows == 0 and dq.skip_if_empty:
            out.skipped = True
            st.append_metrics(spark, audit_path, metrics)
            return out
        if not result.passed:
            metrics.append((run_id, spec.dataset_name, METRIC_VIOLATIONS, float(len(result.violations)), started))
            if q is not None and q.mode == "batch":
                out.quarantine_path = quarantine_batch(visible, q.path, spec.dataset_name, result.reason)
            if dq.fail_pipeline_on_violation:
                st.append_metrics(spark, audit_path, metrics)
                st.append_audit(spark, audit_path, [
                    (run_id, spec.dataset_name, None, None, rows, None, False, result.reason, None,
                     started, _dt.datetime.now(_dt.timezone.utc))])
                log.warning("quality gate failed", extra={"dataset": spec.dataset_name, "run_id": run_id,
                                                          "violations": result.reason})
                raise DataQualityError(spec.dataset_name, result)
        load = df
        if rows_mode:
            bad = int(profile.get(BAD_ROWS) or 0)
            metrics.append((run_id, spec.dataset_name, METRIC_QUARANTINED, float(bad), started))
            if bad:
                out.quarantine_path = quarantine_rows(df.drop(WM, LATE), q.path, spec.dataset_name)
            load = good_rows(df)

        has_late = LATE in df.columns
        shared_bound = len(marks) == len(selected) and len(set(marks.values())) == 1
        # With one shared mark every loaded row is past it, so a non-null max advances
        # it; only differing marks and late rows need the (constant-only) comparison.
        advanced = (_advanced(spark, new_wm, wm_type, marks)
                    if (new_wm is not None and wm_type and marks and (not shared_bound or has_late)) else {})
        audit_rows = []
        for t in selected:
            prev = states.get(t.id)
            tdf = load
            if t.id in marks and has_wm and not shared_bound:
                compound = spec.source.watermark_tie_column is not None
                first, tie = (F.col(WM)[typed.MARK], F.col(WM)[typed.TIE]) if compound else (F.col(WM), None)
                beyond = typed.past(first, tie, marks[t.id], spec.source.watermark_overlap)
                tdf = tdf.filter(beyond | F.col(LATE) if has_late else beyond)
            tdf = tdf.drop(WM, LATE)
            bid = batch_id if batch_id is not None else (prev.batch_id + 1 if prev else 1)
            # code transforms run after the spec's, so they may undo its dedup
            ctx = WriteContext(batch_id=bid, batch_rows=rows, run_time=run_time, column_bytes=column_bytes,
                               keys_unique=_keys_unique(spec, t) and not extra_transforms)
            report = write_with_retry(spark, tdf, t, ctx, spec.retry)
            out.reports.append(report)
            out.targets_written.append(t.id)
            value = prev.value if prev else None
            if new_wm is not None and (t.id not in advanced or advanced[t.id]):
                value = new_wm
            if state_path is not None:
                st.commit_state(spark, state_path, spec.dataset_name, [
                    st.StateEntry(t.id, spec.source.watermark_column, wm_type if value is not None else None,
                                  value, bid)], run_time)
            audit_rows.append((run_id, spec.dataset_name, t.id, bid, rows, report.rows, result.passed,
                               result.reason or None, value, started, _dt.datetime.now(_dt.timezone.utc)))
        st.append_metrics(spark, audit_path, metrics)
        st.append_audit(spark, audit_path, audit_rows)
        if any((r[3] or 0) % st.COMPACT_EVERY == 0 for r in audit_rows):
            st.compact_history(spark, audit_path, spec.dataset_name)
        log.info("run completed", extra={"dataset": spec.dataset_name, "run_id": run_id, "rows": rows,
                                         "targets": out.targets_written, "watermark": new_wm})
        return out
    finally:
        if persist:
            df.unpersist()


def run_many(spark: SparkSession, specs: list[DatasetSpec], parallelism: int = 1,
             **kwargs) -> list[RunResult | BaseException]:
    """Run several datasets, ``parallelism`` at a time from driver threads (Spark schedules
    their jobs side by side; one dataset's failure does not stop the others). Results come
    back in spec order; a failed dataset yields its exception."""
    from concurrent.futures import ThreadPoolExecutor

    def _one(spec: DatasetSpec) -> RunResult | BaseException:
        spark.sparkContext.setJobGroup(f"tidewater-{spec.dataset_name}", f"ingest {spec.dataset_name}")
        try:
            return run(spark, spec, **kwargs)
        except Exception as exc:  # reported per dataset
            return exc

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(_one, specs))

