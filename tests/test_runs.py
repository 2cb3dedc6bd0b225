import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater import DataQualityError, SpecError, run, spec_from_dict
from tidewater.plans import state as st

ORDER_SCHEMA = "order_id bigint, customer_id string, amount double, updated_at string"


def _spec(base, **over):
    raw = {
        "dataset_name": "customer_orders",
        "source": {"type": "parquet", "options": {"path": f"{base}/landing"}, "watermark_column": "updated_at"},
        "targets": [{"type": "file", "options": {"path": f"{base}/target"}, "write_mode": "merge",
                     "merge_keys": ["order_id"]}],
        "state_path": f"{base}/state", "audit_path": f"{base}/audit",
    }
    raw.update(over)
    return spec_from_dict(raw)


def _land(spark, base, rows, schema=ORDER_SCHEMA):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{base}/landing")


def test_empty_batch_fails_row_floor(spark, base):
    spec = _spec(base, data_quality={"min_row_count": 1})
    _land(spark, base, [], "order_id int, customer_id string, updated_at string")
    with pytest.raises(DataQualityError):
        run(spark, spec)
    skip = _spec(base, data_quality={"min_row_count": 1, "skip_if_empty": True})
    assert run(spark, skip).skipped


def test_gate_continue_still_loads(spark, base):
    spec = _spec(base, data_quality={"max_null_fraction": {"customer_id": 0.0}, "fail_pipeline_on_violation": False})
    _land(spark, base, [(1, None, 1.0, "2026-01-01"), (2, "c", 2.0, "2026-01-02")])
    res = run(spark, spec)
    assert not res.quality.passed and res.targets_written == ["file"]
    assert spark.read.parquet(f"{base}/target").count() == 2


def test_failed_gate_quarantines_and_keeps_state(spark, base):
    spec = _spec(base, data_quality={"min_row_count": 10}, quarantine={"path": f"{base}/dlq"})
    _land(spark, base, [(1, "c1", 1.0, "2026-01-01")])
    with pytest.raises(DataQualityError):
        run(spark, spec)
    dlq = spark.read.parquet(f"{base}/dlq/customer_orders").first()
    assert dlq["_dlq_reason"] == "row_count=1 < min_row_count=10"
    assert st.read_state(spark, f"{base}/state", "customer_orders", ["file"]) == {}


def test_row_quarantine_good_plus_bad_is_input(spark, base):
    spec = _spec(base, quarantine={"path": f"{base}/dlq", "mode": "rows", "not_null": ["customer_id"],
                                   "rules": {"negative amount": "amount >= 0"}})
    _land(spark, base, [(1, None, 1.0, "2026-01-01"), (2, "c", -2.0, "2026-01-02"), (3, None, -1.0, "2026-01-02"),
                        (4, "d", 4.0, "2026-01-03")])
    run(spark, spec)
    good = spark.read.parquet(f"{base}/target")
    bad = {r["order_id"]: r["_dlq_reason"] for r in spark.read.parquet(f"{base}/dlq/customer_orders").collect()}
    assert [r["order_id"] for r in good.collect()] == [4]
    assert bad == {1: "null customer_id", 2: "negative amount", 3: "null customer_id; negative amount"}


def test_targets_keep_separate_state(spark, base):
    spec = _spec(base, targets=[
        {"type": "file", "options": {"path": f"{base}/a"}, "write_mode": "merge", "merge_keys": ["order_id"]},
        {"type": "file", "name": "copy", "options": {"path": f"{base}/b"}, "write_mode": "merge",
         "merge_keys": ["order_id"]}])
    _land(spark, base, [(1, "c1", 10.0, "2026-01-01")])
    run(spark, spec, targets=["file"])
    _land(spark, base, [(1, "c1", 10.0, "2026-01-01"), (2, "c2", 20.0, "2026-01-05")])
    run(spark, spec, targets=["file"])
    res = run(spark, spec, targets=["copy"])  # first load of the copy still gets both rows
    assert res.row_count == 2
    assert spark.read.parquet(f"{base}/b").count() == 2 and spark.read.parquet(f"{base}/a").count() == 2
    # both now at the same mark; a third run on both sees nothing new
    assert run(spark, spec, targets=["file", "copy"]).row_count == 0
    with pytest.raises(SpecError):
        run(spark, spec, targets=["nope"])


def test_targets_with_different_marks_get_their_own_rows(spark, base):
    spec = _spec(base, targets=[
        {"type": "file", "options": {"path": f"{base}/a"}},
        {"type": "file", "name": "late", "options": {"path": f"{base}/b"}}])
    _land(spark, base, [(1, "c1", 1.0, "2026-01-01")])
    run(spark, spec)
    _land(spark, base, [(1, "c1", 1.0, "2026-01-01"), (2, "c2", 2.0, "2026-01-02")])
    run(spark, spec, targets=["file"])
    _land(spark, base, [(1, "c1", 1.0, "2026-01-01"), (2, "c2", 2.0, "2026-01-02"), (3, "c3", 3.0, "2026-01-03")])
    run(spark, spec)
    a = sorted(r["order_id"] for r in spark.read.parquet(f"{base}/a").collect())
    b = sorted(r["order_id"] for r in spark.read.parquet(f"{base}/b").collect())
    assert a == [1, 2, 3] and b == [1, 2, 3]


def test_audit_and_metrics(spark, base):
    spec = _spec(base)
    _land(spark, base, [(1, "c1", 10.0, "2026-01-01")])
    res = run(spark, spec)
    audit = st.audit_frame(spark, f"{base}/audit").filter(F.col("run_id") == res.run_id).first()
    assert (audit["target"], audit["row_count"], audit["rows_written"], audit["dq_passed"]) == ("file", 1, 1, True)
    metrics = {r["metric"]: r["value"] for r in
               st.metrics_frame(spark, f"{base}/audit").filter(F.col("run_id") == res.run_id).collect()}
    assert metrics == {"ingestion.row_count": 1.0}


def test_watermark_column_renamed_by_transform(spark, base):
    spec = _spec(base, transforms=[{"type": "rename", "mapping": {"updated_at": "changed"}}])
    _land(spark, base, [(1, "c1", 10.0, "2026-01-01")])
    assert run(spark, spec).watermark == "2026-01-01"


def test_retry_only_replay_safe_writes(spark, base, monkeypatch):
    from tidewater.plans import ingest
    from tidewater.sinks import WriteContext
    from tidewater.spec import RetrySpec, TargetSpec

    calls = []

    def flaky(sp, df, target, ctx):
        calls.append(target.write_mode)
        if len(calls) < 3:
            raise RuntimeError("transient")
        return "ok"

    monkeypatch.setattr(ingest, "write_target", flaky)
    retry = RetrySpec(max_attempts=3, initial_delay_seconds=0.01)
    df = spark.createDataFrame([(1,)], "id bigint")
    merge = TargetSpec("file", {"path": base}, write_mode="merge", merge_keys=["id"])
    assert ingest.write_with_retry(spark, df, merge, WriteContext(), retry) == "ok" and len(calls) == 3
    calls.clear()
    with pytest.raises(RuntimeError):
        ingest.write_with_retry(spark, df, TargetSpec("file", {"path": base}), WriteContext(), retry)
    assert calls == ["append"]  # a plain append is never replayed


def test_state_round_trip_and_last_write_wins(spark, base):
    path = f"{base}/state"
    assert st.read_state(spark, path, "orders", ["file"]) == {}
    st.commit_state(spark, path, "orders", [st.StateEntry("file", "ts", "string", "2026-07-01T00:00:00", 1)])
    assert st.read_state(spark, path, "orders", ["file"])["file"].value == "2026-07-01T00:00:00"
    st.commit_state(spark, path, "orders", [st.StateEntry("file", "ts", "string", "a", 2)])
    st.commit_state(spark, path, "orders", [st.StateEntry("file", "ts", "string", "b", 3)])
    assert st.read_state(spark, path, "orders", ["file"])["file"].value == "b"


def test_retry_exhausts_attempts(spark, base, monkeypatch):
    from tidewater.plans import ingest
    from tidewater.sinks import WriteContext
    from tidewater.spec import RetrySpec, TargetSpec

    calls = []

    def broken(sp, df, target, ctx):
        calls.append(1)
        raise ValueError("permanent")

    monkeypatch.setattr(ingest, "write_target", broken)
    t = TargetSpec("file", {"path": base}, write_mode="overwrite")
    with pytest.raises(ValueError):
        ingest.write_with_retry(spark, spark.range(1), t, WriteContext(),
                                RetrySpec(max_attempts=2, initial_delay_seconds=0.01, backoff_multiplier=1))
    assert len(calls) == 2


def test_checkpointed_batch(spark, base):
    spec = _spec(base, batch_storage="checkpoint", transforms=[
        {"type": "deduplicate", "keys": ["order_id"], "order_by": "updated_at"}])
    _land(spark, base, [(1, "c1", 10.0, "2026-01-01"), (1, "c1", 11.0, "2026-01-02")])
    res = run(spark, spec)
    assert res.row_count == 1
    assert {r["order_id"]: r["amount"] for r in spark.read.parquet(f"{base}/target").collect()} == {1: 11.0}
    from tidewater.plans.ingest import storage_for

    assert storage_for(_spec(base)) == "cache"
    jdbc = _spec(base, source={"type": "jdbc", "options": {"url": "jdbc:x", "dbtable": "t"}})
    assert storage_for(jdbc) == "checkpoint"


def test_overlap_rereads_rows_at_the_mark(spark, base):
    spec = _spec(base, source={"type": "parquet", "options": {"path": f"{base}/landing"},
                               "watermark_column": "updated_at", "watermark_overlap": True})
    _land(spark, base, [(1, "c1", 10.0, "2026-01-01"), (2, "c2", 20.0, "2026-01-02")])
    run(spark, spec)
    # a late row carrying the same timestamp as the stored mark
    _land(spark, base, [(1, "c1", 10.0, "2026-01-01"), (2, "c2", 20.0, "2026-01-02"), (3, "c3", 30.0, "2026-01-02")])
    res = run(spark, spec)
    assert res.row_count == 2  # rows at the mark are read again and merged idempotently
    assert sorted(r["order_id"] for r in spark.read.parquet(f"{base}/target").collect()) == [1, 2, 3]


def test_csv_seed_row_appended_to_table(spark, base):
    """A headered CSV landing file with a declared all-string schema, appended to a table."""
    from tidewater.session import unique_name

    (spark.createDataFrame([("1", "c1", "10.5", "2024-01-01T00:00:00Z")],
                           "order_id string, customer_id string, amount string, updated_at string")
     .coalesce(1).write.option("header", True).csv(f"{base}/csv"))
    table = unique_name("seed")
    spec = spec_from_dict({
        "dataset_name": "customer_orders_local",
        "source": {"type": "s3_csv", "options": {"path": f"{base}/csv"}, "watermark_column": "updated_at",
                   "schema": [{"name": "order_id", "type": "string"}, {"name": "customer_id", "type": "string"},
                              {"name": "amount", "type": "double"}, {"name": "updated_at", "type": "string"}]},
        "transforms": [{"type": "add_metadata"}],
        "targets": [{"type": "hive", "options": {"table": table, "path": f"{base}/table"}}],
        "data_quality": {"min_row_count": 1, "max_null_fraction": {"order_id": 0.0}},
        "state_path": f"{base}/state", "audit_path": f"{base}/audit",
    })
    res = run(spark, spec)
    row = spark.table(table).first()
    assert res.row_count == 1 and row["amount"] == 10.5 and row["_dataset_name"] == "customer_orders_local"
    assert res.watermark == "2024-01-01T00:00:00Z"
    with pytest.raises(DataQualityError):  # idle rerun: nothing past the mark, row floor 1 fails
        run(spark, spec)


def test_prepare_batch_shows_the_pushed_watermark(spark, base):
    from tidewater.plans import prepare_batch

    spec = _spec(base)
    _land(spark, base, [(1, "c1", 10.0, "2026-01-01"), (2, "c2", 20.0, "2026-01-02")])
    run(spark, spec)
    b = prepare_batch(spark, spec, recover=False)
    plan = b.df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(updated_at,2026-01-02)" in plan and b.marks == {"file": ("2026-01-02", "string")}


def test_two_loads_of_the_orders_table(spark, base):
    """The older half first, then everything: the second load reads what is newer only."""
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    middle = orders.approxQuantile("o_orderkey", [0.5], 0.0)[0]
    spec = _spec(base, source={"type": "parquet", "options": {"path": f"{base}/landing"}, "watermark_column": "o_orderkey"},
                 targets=[{"type": "file", "options": {"path": f"{base}/target"}, "write_mode": "merge",
                           "merge_keys": ["o_orderkey"]}],
                 transforms=[{"type": "deduplicate", "keys": ["o_orderkey"], "order_by": "o_orderdate"}, {"type": "add_metadata"}])
    old = orders.filter(F.col("o_orderkey") <= middle)
    old.write.parquet(f"{base}/landing")
    first = run(spark, spec)
    assert first.row_count == old.count() and first.watermark == str(int(middle))
    assert first.reports[0].extra["scope"] == "create"
    orders.write.mode("overwrite").parquet(f"{base}/landing")
    second = run(spark, spec)
    assert second.row_count == orders.count() - old.count()
    out = spark.read.parquet(f"{base}/target")
    assert out.count() == orders.count() and out.select("_ingested_at").distinct().count() == 2


def test_state_has_a_folder_per_commit_and_compacts(spark, base):
    path = f"{base}/state"
    for i in range(1, 4):
        st.commit_state(spark, path, "a/b c", [st.StateEntry("file", "c", "bigint", str(i * 10), i)])
    st.commit_state(spark, path, "other", [st.StateEntry("file", "c", "bigint", "5", 1)])
    assert st.read_state(spark, path, "a/b c", ["file"])["file"].value == "30"
    assert st.state_frame(spark, path).count() == 4
    st.compact_state(spark, path, "a/b c")
    assert st.state_frame(spark, path, "a/b c").count() == 1 and st.state_frame(spark, path).count() == 2
    assert st.read_state(spark, path, "a/b c", ["file"])["file"].batch_id == 3


def test_an_interrupted_compaction_loses_nothing(spark, base, monkeypatch):
    path = f"{base}/state"
    for i in range(1, 3):
        st.commit_state(spark, path, "ds", [st.StateEntry("file", "c", "bigint", str(i), i)])
    monkeypatch.setattr(st.fs, "delete", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        st.compact_state(spark, path, "ds")
    assert st.read_state(spark, path, "ds", ["file"])["file"].value == "2"


def test_many_runs_share_one_state(spark, base):
    from tidewater.plans import run_many

    specs = []
    for i in range(14):
        _land(spark, f"{base}/{i}", [(i, f"c{i}", 1.0, "2026-01-01")])
        specs.append(_spec(f"{base}/{i}", dataset_name=f"ds{i}", state_path=f"{base}/state", audit_path=f"{base}/audit"))
    broken = _spec(f"{base}/missing", dataset_name="broken", state_path=f"{base}/state", audit_path=f"{base}/audit")
    results = run_many(spark, [*specs, broken], parallelism=4)
    assert [getattr(r, "row_count", r) for r in results[:14]] == [1] * 14 and isinstance(results[14], Exception)
    assert st.state_frame(spark, f"{base}/state").select("dataset").distinct().count() == 14
    assert st.audit_frame(spark, f"{base}/audit").count() == 14


def test_state_needs_a_durable_folder(spark):
    spec = spec_from_dict({"dataset_name": "x", "source": {"type": "parquet", "options": {"path": "/nowhere"}},
                           "targets": [{"type": "file", "options": {"path": "/nowhere/t"}}]})
    if spark.conf.get("spark.checkpoint.dir", None):
        pytest.skip("the session names a shared folder")
    with pytest.raises(SpecError, match="spark.checkpoint.dir"):
        run(spark, spec)


def test_overlap_holds_under_diverging_marks(spark, base):
    two = [{"type": "file", "name": n, "options": {"path": f"{base}/{n}"}, "write_mode": "merge", "merge_keys": ["order_id"]}
           for n in ("p", "q")]
    spec = _spec(base, targets=two, source={"type": "parquet", "options": {"path": f"{base}/landing"},
                                            "watermark_column": "updated_at", "watermark_overlap": True})
    rows = [(1, "c", 1.0, "2026-01-10"), (2, "c", 1.0, "2026-01-20"), (3, "c", 1.0, "2026-01-30")]
    st.commit_state(spark, f"{base}/state", "customer_orders", [
        st.StateEntry("p", "updated_at", "string", "2026-01-10", 1), st.StateEntry("q", "updated_at", "string", "2026-01-20", 1)])
    _land(spark, base, rows)
    run(spark, spec)
    got = {n: sorted(r.order_id for r in spark.read.parquet(f"{base}/{n}").collect()) for n in ("p", "q")}
    assert got == {"p": [1, 2, 3], "q": [2, 3]}


def test_a_cast_after_the_dedup_is_checked_for_folded_keys(spark, base):
    from tidewater.errors import DuplicateMergeKeyError

    _land(spark, base, [("1", "c", 1.0, "2026-01-01"), ("01", "c", 2.0, "2026-01-02")],
          "order_id string, customer_id string, amount double, updated_at string")
    spec = _spec(base, transforms=[{"type": "deduplicate", "keys": ["order_id"], "order_by": "updated_at"},
                                   {"type": "cast", "columns": {"order_id": "int"}}])
    with pytest.raises(DuplicateMergeKeyError):
        run(spark, spec)
