import json

from tidewater.__main__ import main


def test_cli_runs_a_spec_directory(spark, base, tmp_path, capsys):
    spark.read.parquet("/root/testdata/sf0.001/orders.parquet").write.parquet(f"{base}/landing")
    spec = {
        "dataset_name": "cli_orders",
        "source": {"type": "s3_parquet", "options": {"path": f"{base}/landing"}, "watermark_column": "o_orderdate"},
        "targets": [{"type": "s3", "options": {"path": f"{base}/target"}, "write_mode": "upsert",
                     "merge_keys": ["o_orderkey"]}],
        "state_path": f"{base}/state", "audit_path": f"{base}/audit",
    }
    (tmp_path / "orders.json").write_text(json.dumps(spec))
    assert main([str(tmp_path), "--parallel", "2"], stop_session=False) == 0
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert first["dataset"] == "cli_orders" and first["rows"] == 1500 and first["targets"] == ["file"]
    assert main([str(tmp_path / "orders.json")], stop_session=False) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["rows"] == 0
