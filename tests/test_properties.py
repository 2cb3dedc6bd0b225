"""Properties from the survey's test strategy, checked on generated inputs."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st_

from tidewater import run, spec_from_dict
from tidewater.session import scratch_path
from tidewater.sinks import write_target
from tidewater.spec import TargetSpec

SCHEMA = "id bigint, val string"
rows_ = st_.dictionaries(st_.integers(0, 30), st_.text("abc", max_size=3), max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=rows_, batch=rows_)
def test_upsert_equals_dict_merge(spark, target, batch):
    path = scratch_path(spark, "prop_upsert")
    t = TargetSpec("file", {"path": path}, write_mode="merge", merge_keys=["id"])
    write_target(spark, spark.createDataFrame(sorted(target.items()), SCHEMA), t)
    write_target(spark, spark.createDataFrame(sorted(batch.items()), SCHEMA), t)
    got = {r["id"]: r["val"] for r in spark.read.parquet(path).collect()}
    assert got == {**target, **batch}
    # keys stay unique, and a second application changes nothing
    write_target(spark, spark.createDataFrame(sorted(batch.items()), SCHEMA), t)
    again = spark.read.parquet(path).collect()
    assert len(again) == len(got) and {r["id"]: r["val"] for r in again} == got


def _orders(spark):
    return spark.read.parquet("/root/testdata/sf0.001/orders.parquet")


def test_initial_plus_incremental_equals_full_load(spark, base):
    orders = _orders(spark)
    landing = f"{base}/landing"
    raw = {
        "dataset_name": "orders",
        "source": {"type": "parquet", "options": {"path": landing}, "watermark_column": "o_orderdate"},
        "targets": [{"type": "file", "options": {"path": f"{base}/target"}}],
        "state_path": f"{base}/state", "audit_path": f"{base}/audit",
    }
    spec = spec_from_dict(raw)
    orders.filter("o_orderdate < '1997-06-01'").write.parquet(landing)
    run(spark, spec)
    orders.filter("o_orderdate >= '1997-06-01'").write.mode("append").parquet(landing)
    run(spark, spec)
    out = spark.read.parquet(f"{base}/target")
    assert out.count() == orders.count() and out.exceptAll(orders).count() == 0


def test_stream_form_equals_batch_form(spark, base):
    from tidewater.streaming import run_available_now

    orders = _orders(spark)
    schema = [{"name": f.name, "type": f.dataType.simpleString()} for f in orders.schema.fields]
    common = {
        "dataset_name": "orders",
        "transforms": [{"type": "deduplicate", "keys": ["o_custkey"], "order_by": "o_orderdate",
                        "tie_breakers": ["o_orderkey"]}],
        "audit_path": f"{base}/audit", "state_path": f"{base}/state",
    }
    orders.write.parquet(f"{base}/in")
    batch_spec = spec_from_dict({**common, "source": {"type": "parquet", "options": {"path": f"{base}/in"}},
                                 "targets": [{"type": "file", "options": {"path": f"{base}/b"}}]})
    stream_spec = spec_from_dict({**common, "source": {"type": "parquet", "options": {"path": f"{base}/in"},
                                                       "schema": schema},
                                  "targets": [{"type": "file", "options": {"path": f"{base}/s"}}]})
    run(spark, batch_spec)
    run_available_now(spark, stream_spec, checkpoint=f"{base}/ckpt")
    b, s = spark.read.parquet(f"{base}/b"), spark.read.parquet(f"{base}/s")
    assert b.count() == s.count() and b.exceptAll(s).count() == 0
