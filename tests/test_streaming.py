import pytest

from tidewater import spec_from_dict
from tidewater.errors import SpecError
from tidewater.streaming import run_available_now


def test_available_now_picks_up_only_new_files(spark, base):
    schema = [{"name": "id", "type": "bigint"}, {"name": "val", "type": "string"}]
    spec = spec_from_dict({
        "dataset_name": "s",
        "source": {"type": "parquet", "options": {"path": f"{base}/in"}, "schema": schema},
        "targets": [{"type": "file", "options": {"path": f"{base}/out"}, "write_mode": "merge",
                     "merge_keys": ["id"]}],
        "audit_path": f"{base}/audit",
    })
    spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, val string").write.mode("append").parquet(f"{base}/in")
    first = run_available_now(spark, spec, checkpoint=f"{base}/ckpt")
    spark.createDataFrame([(2, "b2"), (3, "c")], "id bigint, val string").write.mode("append").parquet(f"{base}/in")
    second = run_available_now(spark, spec, checkpoint=f"{base}/ckpt")
    assert sum(r.row_count for r in first) == 2 and sum(r.row_count for r in second) == 2
    out = {r["id"]: r["val"] for r in spark.read.parquet(f"{base}/out").collect()}
    assert out == {1: "a", 2: "b2", 3: "c"}
    assert run_available_now(spark, spec, checkpoint=f"{base}/ckpt") == []


SCHEMA = [{"name": "id", "type": "bigint"}, {"name": "at", "type": "timestamp"}, {"name": "val", "type": "string"}]


def _dedup_spec(base, target, **dedup):
    return spec_from_dict({
        "dataset_name": "s", "source": {"type": "parquet", "options": {"path": f"{base}/in", "maxFilesPerTrigger": "1"}, "schema": SCHEMA},
        "transforms": [{"type": "add_metadata"}, {"type": "deduplicate", "keys": ["id"], "across_batches": True, **dedup},
                       {"type": "drop", "columns": ["_ingested_at"]}],
        "targets": [{"type": "file", "options": {"path": f"{base}/out"}, **target}], "audit_path": f"{base}/audit"})


def _land(spark, base, rows):
    df = spark.createDataFrame(rows, "id bigint, at string, val string").selectExpr("id", "cast(at AS timestamp) AS at", "val")
    df.coalesce(1).write.mode("append").parquet(f"{base}/in")


MERGE = {"write_mode": "merge", "merge_keys": ["id"]}


def test_latest_row_over_the_whole_stream(spark, base):
    spec = _dedup_spec(base, MERGE, order_by="at")
    _land(spark, base, [(1, "2024-01-05", "new"), (2, "2024-01-01", "a")])
    _land(spark, base, [(1, "2024-01-02", "late and old"), (3, "2024-01-01", "c")])
    assert len(run_available_now(spark, spec, checkpoint=f"{base}/ckpt")) == 2
    _land(spark, base, [(1, "2024-01-03", "still old"), (2, "2024-01-09", "b"), (3, None, "no order")])  # after a restart
    run_available_now(spark, spec, checkpoint=f"{base}/ckpt")
    assert {r["id"]: r["val"] for r in spark.read.parquet(f"{base}/out").collect()} == {1: "new", 2: "b", 3: "c"}


@pytest.mark.parametrize("bound", [{}, {"event_time": "at", "within": "30 days"}])
def test_first_row_over_the_whole_stream(spark, base, bound):
    spec = _dedup_spec(base, {"write_mode": "append", "idempotent": True}, **bound)
    _land(spark, base, [(1, "2024-01-05", "x"), (1, "2024-01-05", "x"), (2, "2024-01-05", "y")])
    _land(spark, base, [(1, "2024-01-06", "again")])
    run_available_now(spark, spec, checkpoint=f"{base}/ckpt")
    _land(spark, base, [(2, "2024-01-07", "again"), (3, "2024-01-07", "z")])
    run_available_now(spark, spec, checkpoint=f"{base}/ckpt")
    got = spark.read.parquet(f"{base}/out")
    assert sorted((r["id"], r["val"]) for r in got.collect()) == [(1, "x"), (2, "y"), (3, "z")]


@pytest.mark.parametrize("target,dedup", [({"write_mode": "append"}, {"order_by": "at"}),
                                          ({"write_mode": "merge", "merge_keys": ["id", "val"]}, {"order_by": "at"}),
                                          (MERGE, {"within": "1 hour"})])
def test_refused_stream_specs(spark, base, target, dedup):
    _land(spark, base, [(1, None, "x")])
    with pytest.raises(SpecError):
        run_available_now(spark, _dedup_spec(base, target, **dedup), checkpoint=f"{base}/ckpt")
