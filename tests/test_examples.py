from pathlib import Path

from tidewater import load_spec, run
from tidewater.session import unique_name

EXAMPLES = Path(__file__).resolve().parent.parent / "examples"


def test_example_spec_runs_twice(spark, base):
    spec = load_spec(EXAMPLES / "orders_incremental.yaml")
    assert [t.id for t in spec.targets] == ["curated_files", "curated_table"]
    assert spec.retry.initial_delay_seconds == 5 and spec.sla["max_runtime_minutes"] == 30
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    landing = f"{base}/landing"
    orders.filter("o_orderdate < '1998-01-01'").write.parquet(landing)
    spec.source.options["path"] = landing
    files, table = spec.targets
    files.options.update(path=f"{base}/curated", manifest_path=f"{base}/manifest")
    table.options.update(table=unique_name("curated"), path=f"{base}/table")
    spec.state_path, spec.audit_path = f"{base}/state", f"{base}/audit"
    first = run(spark, spec)
    orders.filter("o_orderdate >= '1998-01-01'").write.mode("append").parquet(landing)
    second = run(spark, spec)
    assert first.row_count + second.row_count == orders.count()
    assert spark.read.parquet(f"{base}/curated").count() == orders.count()
    assert spark.table(table.options["table"]).count() == orders.count()
    manifest = spark.read.json(f"{base}/manifest").first()
    # the second batch holds only new orders: appended, so the write has just those rows
    assert manifest["total_rows"] == orders.count() and manifest["row_count"] == second.row_count
