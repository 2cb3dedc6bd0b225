import json

import pytest

from tidewater.errors import SpecError, UnsupportedWriteModeError
from tidewater.spec import load_spec, load_spec_dir, spec_from_dict


def _raw(**over):
    raw = {
        "dataset_name": "customer_orders",
        "source": {"type": "s3_parquet", "options": {"path": "/x"}},
        "targets": [{"type": "s3", "options": {"path": "/y"}}],
    }
    raw.update(over)
    return raw


def test_defaults():
    spec = spec_from_dict(_raw())
    t = spec.targets[0]
    assert (t.type, t.write_mode, t.merge_keys, t.partition_columns) == ("file", "append", [], [])
    assert spec.source.type == "parquet"
    dq = spec.data_quality
    assert dq.enabled and dq.min_row_count == 0 and dq.max_null_fraction == {} and dq.fail_pipeline_on_violation
    assert spec.owner == "data-eng"
    assert spec.sla["max_runtime_minutes"] == 60


def test_merge_requires_keys():
    with pytest.raises(SpecError):
        spec_from_dict(_raw(targets=[{"type": "hive", "options": {"table": "t"}, "write_mode": "merge"}]))


def test_upsert_is_merge():
    spec = spec_from_dict(_raw(targets=[{"type": "hive", "options": {"table": "t"}, "write_mode": "upsert",
                                         "merge_keys": ["id"]}]))
    assert spec.targets[0].is_merge and spec.targets[0].type == "table"


@pytest.mark.parametrize("name", ["", "bad-name", "has space"])
def test_bad_dataset_name(name):
    with pytest.raises(SpecError):
        spec_from_dict(_raw(dataset_name=name))


def test_bad_write_mode():
    with pytest.raises(UnsupportedWriteModeError):
        spec_from_dict(_raw(targets=[{"type": "s3", "options": {"path": "/y"}, "write_mode": "bogus"}]))


def test_schema_alias_and_fields(spark):
    spec = spec_from_dict(_raw(source={"type": "s3_csv", "options": {"path": "/x"},
                                       "schema_fields": [{"name": "id", "type": "bigint", "nullable": False}]}))
    st = spec.source.struct_type()
    assert st.fieldNames() == ["id"] and not st.fields[0].nullable


def test_duplicate_target_ids_need_names():
    two = [{"type": "s3", "options": {"path": "/a"}}, {"type": "s3", "options": {"path": "/b"}}]
    with pytest.raises(SpecError):
        spec_from_dict(_raw(targets=two))
    two[1]["name"] = "copy"
    assert [t.id for t in spec_from_dict(_raw(targets=two)).targets] == ["file", "copy"]


def test_overlap_needs_merge_targets():
    with pytest.raises(SpecError):
        spec_from_dict(_raw(source={"type": "parquet", "options": {"path": "/x"}, "watermark_column": "ts",
                                    "watermark_overlap": True}))


def test_load_yaml_json_and_dir(tmp_path):
    (tmp_path / "b.yaml").write_text(
        "dataset_name: b\nsource: {type: s3_json, options: {path: /x}}\ntargets: [{type: s3, options: {path: /y}}]\n")
    (tmp_path / "a.json").write_text(json.dumps(_raw(dataset_name="a")))
    (tmp_path / "c.yml").write_text(
        "dataset_name: c\nsource: {type: hive, options: {table: t}}\ntargets: [{type: hive, options: {table: u}}]\n")
    assert load_spec(tmp_path / "a.json").dataset_name == "a"
    assert [s.dataset_name for s in load_spec_dir(tmp_path)] == ["b", "c", "a"]
    (tmp_path / "d.txt").write_text("x")
    with pytest.raises(SpecError):
        load_spec(tmp_path / "d.txt")
