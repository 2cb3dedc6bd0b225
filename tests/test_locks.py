"""Runs racing for one target, and the history they leave."""
import json
import threading
import time

import pytest
from pyspark.sql import functions as F

from tidewater import fs, spec_from_dict
from tidewater.errors import TargetBusyError
from tidewater.plans import run
from tidewater.plans import state as st
from tidewater.plans.locks import lock_path, target_locks


def _spec(base, mode, name="ds"):
    target = {"type": "file", "options": {"path": f"{base}/out"}, "write_mode": mode}
    return spec_from_dict({
        "dataset_name": name, "source": {"type": "parquet", "options": {"path": f"{base}/in"}, "watermark_column": "id"},
        "targets": [{**target, "merge_keys": ["id"]} if mode == "merge" else target],
        "data_quality": {"skip_if_empty": True}, "state_path": f"{base}/state", "audit_path": f"{base}/audit"})


@pytest.mark.parametrize("mode", ["append", "merge"])
def test_two_runs_at_once_are_as_two_in_a_row(spark, base, mode):
    spark.range(100).write.parquet(f"{base}/in")
    slow = threading.Event()
    results, errors = [], []

    def late_rows(df):  # while the first run is under way, more rows land and the second starts
        if not slow.is_set():
            slow.set()
            spark.range(100, 150).write.mode("append").parquet(f"{base}/in")
            time.sleep(3)
        return df

    def go(**kw):
        try:
            results.append(run(spark, _spec(base, mode), **kw))
        except BaseException as e:
            errors.append(e)

    first = threading.Thread(target=go, kwargs={"transforms": [late_rows]})
    second = threading.Thread(target=go)
    first.start()
    slow.wait(60)
    second.start()
    first.join()
    second.join()
    assert not errors
    got = sorted(r["id"] for r in spark.read.parquet(f"{base}/out").collect())
    assert got == list(range(150))
    assert sorted(r.row_count for r in results if not r.skipped)[-1] in (50, 100, 150)
    assert not fs.exists(spark, lock_path(f"{base}/state", "ds", "file"))


def test_a_held_target_is_waited_for_and_given_up(spark, base):
    with target_locks(spark, base, "ds", ["a", "b"], "one"):
        with pytest.raises(TargetBusyError, match="run one"):
            with target_locks(spark, base, "ds", ["b"], "two", wait=1.0):
                pass
        with target_locks(spark, base, "ds", ["c"], "two", wait=1.0):  # another target is free
            pass
    with target_locks(spark, base, "ds", ["a", "b"], "two", wait=0.0):
        pass


def test_a_dead_runs_lock_is_taken_over(spark, base):
    path = lock_path(base, "ds", "a")
    assert fs.create_if_absent(spark, path, json.dumps({"owner": "dead", "beat": time.time() - 100}))
    assert not fs.create_if_absent(spark, path, "{}")
    with target_locks(spark, base, "ds", ["a"], "two", wait=5.0, stale_after=50.0):
        assert json.loads(fs.read_text(spark, path))["owner"].startswith("two/")
    assert not fs.exists(spark, path)


def test_beats_keep_a_long_runs_lock(spark, base):
    with target_locks(spark, base, "ds", ["a"], "one", stale_after=1.5):
        time.sleep(3)
        with pytest.raises(TargetBusyError):
            with target_locks(spark, base, "ds", ["a"], "two", wait=1.0, stale_after=1.5):
                pass
    assert not fs.exists(spark, lock_path(base, "ds", "a"))


def test_a_failed_run_gives_its_locks_back(spark, base):
    with pytest.raises(Exception):
        run(spark, _spec(base, "append"))  # nothing to read
    assert not fs.exists(spark, lock_path(f"{base}/state", "ds", "file"))


def test_history_is_put_together_and_keeps_every_row(spark, base):
    when = __import__("datetime").datetime(2026, 1, 1)
    folder = f"{base}/audit/metrics/dataset=ds"
    for k in range(6):
        st.append_metrics(spark, f"{base}/audit", [(f"run{k}", "ds", "rows", float(k), when)])
        if k in (2, 4):
            st.compact_history(spark, f"{base}/audit", "ds")
    names = [n for n in fs.list_names(spark, folder) if n.startswith("commit=")]
    assert len(names) == 3 and sum(n.startswith("commit=t-") for n in names) == 2
    got = st.metrics_frame(spark, f"{base}/audit")
    assert sorted(r["run_id"] for r in got.collect()) == [f"run{k}" for k in range(6)]
    # a crash between writing and removing leaves rows twice in the files, once for readers
    copy = spark.read.schema(st.METRIC_SCHEMA).parquet(f"{folder}/{names[0]}")
    copy.coalesce(1).write.parquet(f"{folder}/commit=crashed")
    assert st.metrics_frame(spark, f"{base}/audit").count() == 6


def test_many_commits_are_read_with_few_driver_calls(spark, base, monkeypatch):
    """One file-system call for the folder, none for each commit."""
    path = f"{base}/state"
    st.commit_state(spark, path, "ds", [st.StateEntry("file", "c", "bigint", "1", 1)])
    one = spark.read.schema(st.STATE_SCHEMA).parquet(f"{path}/dataset=ds")
    for k in range(2, 40):
        (one.withColumn("batch_id", F.lit(k).cast("bigint")).withColumn("value", F.lit(str(k)))
         .select(*st.STATE_SCHEMA.fieldNames()).coalesce(1).write.parquet(f"{path}/dataset=ds/commit={k}"))
    calls = []
    real = fs._fs
    monkeypatch.setattr(fs, "_fs", lambda *a: calls.append(a) or real(*a))
    assert st.read_state(spark, path, "ds", ["file"])["file"].value == "39"
    assert len(calls) <= 4
