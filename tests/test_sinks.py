import json

import pytest

from tidewater import fs
from tidewater.errors import DuplicateMergeKeyError, UnknownConnectorError, UnsupportedWriteModeError
from tidewater.session import unique_name
from tidewater.sinks import WriteContext, merge_statement, register_target, write_target
from tidewater.sinks.files import recover_file_target
from tidewater.spec import TargetSpec

SCHEMA = "id bigint, val string"


def _df(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def _as_dict(df):
    return {r["id"]: r["val"] for r in df.collect()}


def _file(base, **kw):
    return TargetSpec("file", {"path": f"{base}/t", **kw.pop("options", {})}, **kw)


def _table(spark, base, **kw):
    return TargetSpec("table", {"table": unique_name("t"), "path": f"{base}/t", **kw.pop("options", {})}, **kw)


def test_partitioned_layout(spark, base):
    write_target(spark, _df(spark, [(1, "us"), (2, "eu")], "id bigint, region string"),
                 _file(base, partition_columns=["region"]))
    names = sorted(p.rsplit("/", 1)[-1] for p in fs.list_dirs(spark, f"{base}/t"))
    assert names == ["region=eu", "region=us"]


@pytest.mark.parametrize("kind", ["file", "table"])
def test_upsert_twice_is_once(spark, base, kind):
    t = _file(base, write_mode="merge", merge_keys=["id"]) if kind == "file" else \
        _table(spark, base, write_mode="merge", merge_keys=["id"])
    write_target(spark, _df(spark, [(1, "a"), (2, "b")]), t)
    batch = _df(spark, [(2, "x"), (3, "y")])
    write_target(spark, batch, t)
    write_target(spark, batch, t)
    out = spark.read.parquet(f"{base}/t") if kind == "file" else spark.table(t.options["table"])
    assert out.count() == 3 and _as_dict(out) == {1: "a", 2: "x", 3: "y"}


def test_upsert_duplicate_keys_raise(spark, base):
    t = _file(base, write_mode="merge", merge_keys=["id"])
    with pytest.raises(DuplicateMergeKeyError):
        write_target(spark, _df(spark, [(1, "a"), (1, "b")]), t)
    allow = _file(base, write_mode="merge", merge_keys=["id"], duplicate_keys="allow")
    write_target(spark, _df(spark, [(1, "a"), (1, "b")]), allow)
    assert spark.read.parquet(f"{base}/t").count() == 2


def test_upsert_null_keys(spark, base):
    t = _file(base, write_mode="merge", merge_keys=["id"])
    write_target(spark, _df(spark, [(None, "a"), (1, "b")]), t)
    write_target(spark, _df(spark, [(None, "c")]), t)
    assert spark.read.parquet(f"{base}/t").count() == 3  # NULL never matches (parity)
    safe = TargetSpec("file", {"path": f"{base}/s"}, write_mode="merge", merge_keys=["id"], null_safe_keys=True)
    write_target(spark, _df(spark, [(None, "a"), (1, "b")]), safe)
    write_target(spark, _df(spark, [(None, "c")]), safe)
    assert _as_dict(spark.read.parquet(f"{base}/s")) == {None: "c", 1: "b"}


@pytest.mark.parametrize("kind", ["file", "table"])
def test_upsert_schema_union(spark, base, kind):
    t = _file(base, write_mode="merge", merge_keys=["id"]) if kind == "file" else \
        _table(spark, base, write_mode="merge", merge_keys=["id"])
    write_target(spark, _df(spark, [(1, "a"), (2, "b")]), t)
    write_target(spark, _df(spark, [(2, 20)], "id bigint, extra bigint"), t)
    out = spark.read.parquet(f"{base}/t") if kind == "file" else spark.table(t.options["table"])
    rows = {r["id"]: (r["val"], r["extra"]) for r in out.collect()}
    assert rows == {1: ("a", None), 2: (None, 20)}


@pytest.mark.parametrize("commit", ["rename", "copy"])
def test_upsert_partition_scoped(spark, base, commit):
    t = _file(base, write_mode="merge", merge_keys=["id", "region"], partition_columns=["region"],
              options={"commit": commit})
    write_target(spark, _df(spark, [(1, "us", "a"), (2, "eu", "b")], "id bigint, region string, val string"), t)
    before = sorted(f for f in fs.list_dirs(spark, f"{base}/t"))
    us_files = spark.read.parquet(f"{base}/t/region=us").inputFiles()
    report = write_target(spark, _df(spark, [(2, "eu", "b2"), (3, "eu", "c")], "id bigint, region string, val string"), t)
    assert report.extra["scope"] == "dynamic" and report.extra["commit"] == commit
    assert spark.read.parquet(f"{base}/t/region=us").inputFiles() == us_files  # untouched partition kept
    assert sorted(fs.list_dirs(spark, f"{base}/t")) == before
    assert _as_dict(spark.read.parquet(f"{base}/t")) == {1: "a", 2: "b2", 3: "c"}


def test_partition_values_keep_their_type(spark, base):
    t = _file(base, write_mode="merge", merge_keys=["id", "code"], partition_columns=["code"])
    write_target(spark, _df(spark, [(1, "01", "a")], "id bigint, code string, val string"), t)
    write_target(spark, _df(spark, [(2, "01", "b")], "id bigint, code string, val string"), t)
    out = spark.read.schema("id bigint, val string, code string").parquet(f"{base}/t")
    assert sorted((r["id"], r["code"]) for r in out.collect()) == [(1, "01"), (2, "01")]


def test_complete_stage_is_reapplied(spark, base):
    t = _file(base, write_mode="merge", merge_keys=["id"])
    write_target(spark, _df(spark, [(1, "a")]), t)
    # a run died after its stage committed but before the target was replaced
    staged = _df(spark, [(1, "a"), (2, "b")])
    fs.write_text(spark, f"{base}/t__stage_static.schema.json", staged.schema.json())
    staged.write.parquet(f"{base}/t__stage_static")
    assert recover_file_target(spark, t)
    assert _as_dict(spark.read.parquet(f"{base}/t")) == {1: "a", 2: "b"}
    assert not fs.exists(spark, f"{base}/t__stage_static")


def test_incomplete_stage_is_discarded(spark, base):
    t = _file(base, write_mode="merge", merge_keys=["id"])
    write_target(spark, _df(spark, [(1, "a")]), t)
    _df(spark, [(9, "z")]).write.parquet(f"{base}/t__stage_static")
    fs.delete(spark, f"{base}/t__stage_static/_SUCCESS")
    assert not recover_file_target(spark, t)
    assert _as_dict(spark.read.parquet(f"{base}/t")) == {1: "a"}


def test_idempotent_append_replay(spark, base):
    t = _file(base, idempotent=True)
    write_target(spark, _df(spark, [(1, "a")]), t, WriteContext(batch_id=1))
    write_target(spark, _df(spark, [(2, "b")]), t, WriteContext(batch_id=2))
    write_target(spark, _df(spark, [(2, "b")]), t, WriteContext(batch_id=2))
    out = spark.read.parquet(f"{base}/t")
    assert sorted((r["id"], r["_batch_id"]) for r in out.collect()) == [(1, 1), (2, 2)]


def test_manifest(spark, base):
    t = _file(base, options={"manifest_path": f"{base}/m"})
    df = _df(spark, [(1, "a"), (2, "b")])
    write_target(spark, df, t, WriteContext(batch_id=7))
    m = spark.read.json(f"{base}/m").first()
    assert m["row_count"] == 2 and m["path"] == f"{base}/t" and m["batch_id"] == 7 and m["total_rows"] == 2
    write_target(spark, df, t, WriteContext(batch_id=8))  # append: batch count and total differ
    m8 = spark.read.json(f"{base}/m").first()
    assert (m8["row_count"], m8["total_rows"]) == (2, 4)
    # order-insensitive content checksum: same rows in another order and partitioning
    t2 = TargetSpec("file", {"path": f"{base}/t2", "manifest_path": f"{base}/m2"})
    write_target(spark, df.orderBy("id", ascending=False).repartition(3), t2)
    assert spark.read.json(f"{base}/m2").first()["checksum"] == m["checksum"]


def test_table_append_by_name_and_overwrite(spark, base):
    t = _table(spark, base)
    write_target(spark, _df(spark, [(1, "a")]), t)
    write_target(spark, _df(spark, [("b", 2)], "val string, id bigint"), t)
    assert _as_dict(spark.table(t.options["table"])) == {1: "a", 2: "b"}
    t.write_mode = "overwrite"
    write_target(spark, _df(spark, [(3, "c")]), t)
    assert _as_dict(spark.table(t.options["table"])) == {3: "c"}


def test_unknown_target_and_mode(spark):
    df = spark.createDataFrame([(1,)], "id bigint")
    with pytest.raises(UnknownConnectorError):
        write_target(spark, df, TargetSpec("nope", {}))
    t = TargetSpec("file", {"path": "/unused"})
    t.write_mode = "bogus"
    with pytest.raises(UnsupportedWriteModeError):
        write_target(spark, df, t)


def test_merge_statement():
    sql = merge_statement("ORDERS", "ORDERS_stage_3", ["id", "val"], ["id"])
    assert sql == ("MERGE INTO ORDERS t USING ORDERS_stage_3 s ON t.id = s.id "
                   "WHEN MATCHED THEN UPDATE SET val = s.val "
                   "WHEN NOT MATCHED THEN INSERT (id, val) VALUES (s.id, s.val)")
    keys_only = merge_statement("T", "S", ["id"], ["id"])
    assert "UPDATE" not in keys_only and keys_only.endswith("INSERT (id) VALUES (s.id)")


@pytest.mark.parametrize("commit", ["rename", "copy"])
def test_upsert_commit_modes(spark, base, commit):
    t = _file(base, write_mode="merge", merge_keys=["id"], options={"commit": commit})
    write_target(spark, _df(spark, [(1, "a"), (2, "b")]), t)
    report = write_target(spark, _df(spark, [(2, "b2"), (3, "c")]), t)
    assert report.extra["commit"] == commit
    assert _as_dict(spark.read.parquet(f"{base}/t")) == {1: "a", 2: "b2", 3: "c"}
    assert not fs.exists(spark, f"{base}/t__stage_static") and not fs.exists(spark, f"{base}/t__old")


def test_half_finished_swap_is_completed(spark, base):
    t = _file(base, write_mode="merge", merge_keys=["id"], options={"commit": "rename"})
    write_target(spark, _df(spark, [(1, "a")]), t)
    # died after moving the live data aside, before moving the stage in
    _df(spark, [(1, "a"), (2, "b")]).write.parquet(f"{base}/t__stage_static")
    fs.rename(spark, f"{base}/t", f"{base}/t__old")
    assert recover_file_target(spark, t)
    assert _as_dict(spark.read.parquet(f"{base}/t")) == {1: "a", 2: "b"}
    assert not fs.exists(spark, f"{base}/t__old")


def test_half_finished_swap_without_stage_rolls_back(spark, base):
    t = _file(base, write_mode="merge", merge_keys=["id"], options={"commit": "rename"})
    write_target(spark, _df(spark, [(1, "a")]), t)
    fs.rename(spark, f"{base}/t", f"{base}/t__old")
    assert recover_file_target(spark, t)
    assert _as_dict(spark.read.parquet(f"{base}/t")) == {1: "a"}


@pytest.mark.parametrize("commit", ["rename", "copy"])
@pytest.mark.parametrize("partitioned", [False, True])
def test_table_upsert_commit_modes(spark, base, commit, partitioned):
    schema = "id bigint, region string, val string"
    t = _table(spark, base, write_mode="merge", merge_keys=["id"], options={"commit": commit},
               partition_columns=["region"] if partitioned else [])
    write_target(spark, _df(spark, [(1, "us", "a"), (2, "eu", "b")], schema), t)
    report = write_target(spark, _df(spark, [(2, "eu", "b2"), (3, "apac", "c")], schema), t)
    # partitioned by a column outside the key: only the touched partitions (eu, apac) are rewritten
    assert report.extra["commit"] == commit and report.rows == (2 if partitioned else 3)
    assert _as_dict(spark.table(t.options["table"])) == {1: "a", 2: "b2", 3: "c"}
    if partitioned:
        parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {t.options['table']}").collect()}
        assert parts == {"region=us", "region=eu", "region=apac"}


def test_bucketed_table_upsert_does_not_shuffle_target(spark, base):
    from tidewater.operators import merge_plan

    t = _table(spark, base, write_mode="merge", merge_keys=["id"], options={"bucket_count": 4})
    write_target(spark, _df(spark, [(i, str(i)) for i in range(100)]), t)
    existing = spark.table(t.options["table"])
    batch = _df(spark, [(5, "x"), (500, "y")])
    plan = merge_plan(existing, batch, ["id"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in text and text.count("Exchange hashpartitioning") == 1
    write_target(spark, batch, t)
    out = _as_dict(spark.table(t.options["table"]))
    assert len(out) == 101 and out[5] == "x" and out[500] == "y"


def test_partition_swap_resumes_after_crash(spark, base):
    schema = "id bigint, region string, val string"
    t = _file(base, write_mode="merge", merge_keys=["id", "region"], partition_columns=["region"],
              options={"commit": "rename"})
    write_target(spark, _df(spark, [(1, "us", "a"), (2, "eu", "b"), (3, "apac", "c")], schema), t)
    staged = _df(spark, [(1, "us", "a2"), (2, "eu", "b2")], schema)
    stage = f"{base}/t__stage_dynamic"
    fs.write_text(spark, stage + ".schema.json", staged.schema.json())
    staged.write.partitionBy("region").parquet(stage)
    fs.write_text(spark, stage + ".plan.json", '{"replace": ["region=eu", "region=us"], "remove": []}')
    # died after swapping region=eu only
    fs.mkdirs(spark, f"{base}/t__old")
    fs.rename(spark, f"{base}/t/region=eu", f"{base}/t__old/region=eu")
    fs.rename(spark, f"{stage}/region=eu", f"{base}/t/region=eu")
    assert recover_file_target(spark, t)
    assert _as_dict(spark.read.parquet(f"{base}/t")) == {1: "a2", 2: "b2", 3: "c"}
    assert not fs.exists(spark, stage) and not fs.exists(spark, f"{base}/t__old")


def test_partitioned_upsert_adding_columns_rewrites_all(spark, base):
    t = _file(base, write_mode="merge", merge_keys=["id", "region"], partition_columns=["region"])
    write_target(spark, _df(spark, [(1, "us", "a"), (2, "eu", "b")], "id bigint, region string, val string"), t)
    report = write_target(spark, _df(spark, [(2, "eu", "b2", 7)], "id bigint, region string, val string, n bigint"), t)
    assert report.extra["scope"] == "static"
    rows = {r["id"]: (r["val"], r["n"]) for r in spark.read.parquet(f"{base}/t").collect()}
    assert rows == {1: ("a", None), 2: ("b2", 7)}


def test_overwrite_touched_partitions_only(spark, base):
    schema = "id bigint, region string"
    t = _file(base, write_mode="overwrite", partition_columns=["region"], options={"overwrite_scope": "partitions"})
    write_target(spark, _df(spark, [(1, "us"), (2, "eu")], schema), t)
    write_target(spark, _df(spark, [(3, "eu")], schema), t)
    assert sorted((r["id"], r["region"]) for r in spark.read.parquet(f"{base}/t").collect()) == [(1, "us"), (3, "eu")]


def test_unreadable_target_is_not_overwritten(spark, base):
    t = _file(base, write_mode="merge", merge_keys=["id"])
    fs.write_text(spark, f"{base}/t/part-0.parquet", "not parquet at all")
    with pytest.raises(Exception):
        write_target(spark, _df(spark, [(1, "a")]), t)
    assert fs.exists(spark, f"{base}/t/part-0.parquet")  # the existing data is left alone


def test_delta_merge_statement():
    from tidewater.sinks.delta import merge_into_sql

    assert merge_into_sql("delta.`/p`", "v", ["id"]) == (
        "MERGE INTO delta.`/p` AS t USING v AS s ON t.`id` = s.`id` "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")



@pytest.mark.parametrize("commit", ["rename", "copy"])
def test_upsert_partitions_outside_key_moves_rows(spark, base, commit):
    """Partitioned by region, keyed by id: a key that changes region leaves its old
    partition, which is removed once empty; untouched partitions keep their files."""
    schema = "id bigint, region string, val string"
    t = _file(base, write_mode="merge", merge_keys=["id"], partition_columns=["region"],
              options={"commit": commit})
    write_target(spark, _df(spark, [(1, "us", "a"), (2, "eu", "b"), (3, "apac", "c"), (4, "us", "d")], schema), t)
    apac_files = spark.read.parquet(f"{base}/t/region=apac").inputFiles()
    report = write_target(spark, _df(spark, [(2, "us", "b2"), (5, "latam", "e")], schema), t)
    assert report.extra["scope"] == "dynamic" and report.extra["removed"] == 1
    out = {r["id"]: (r["region"], r["val"]) for r in spark.read.parquet(f"{base}/t").collect()}
    assert out == {1: ("us", "a"), 2: ("us", "b2"), 3: ("apac", "c"), 4: ("us", "d"), 5: ("latam", "e")}
    assert not fs.exists(spark, f"{base}/t/region=eu")
    assert spark.read.parquet(f"{base}/t/region=apac").inputFiles() == apac_files


def test_partition_values_with_special_characters(spark, base):
    schema = "id bigint, region string, val string"
    t = _file(base, write_mode="merge", merge_keys=["id"], partition_columns=["region"])
    write_target(spark, _df(spark, [(1, "a b:c/d", "x"), (2, None, "y")], schema), t)
    write_target(spark, _df(spark, [(1, "other", "x2"), (2, "z", "y2")], schema), t)
    out = {r["id"]: (r["region"], r["val"]) for r in
           spark.read.schema("id bigint, val string, region string").parquet(f"{base}/t").collect()}
    assert out == {1: ("other", "x2"), 2: ("z", "y2")}


def test_table_upsert_partitions_outside_key(spark, base):
    schema = "id bigint, val string, region string"
    t = _table(spark, base, write_mode="merge", merge_keys=["id"], partition_columns=["region"])
    write_target(spark, _df(spark, [(1, "a", "us"), (2, "b", "eu"), (3, "c", "apac")], schema), t)
    report = write_target(spark, _df(spark, [(2, "b2", "us")], schema), t)
    assert report.extra["scope"] == "dynamic" and report.extra["removed"] == 1
    name = t.options["table"]
    assert {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()} == {"region=us", "region=apac"}
    out = {r["id"]: (r["val"], r["region"]) for r in spark.table(name).collect()}
    assert out == {1: ("a", "us"), 2: ("b2", "us"), 3: ("c", "apac")}


@pytest.mark.parametrize("commit", ["rename", "copy"])
def test_failed_overwrite_keeps_old_data(spark, base, commit):
    t = _file(base, write_mode="overwrite", options={"commit": commit})
    write_target(spark, _df(spark, [(1, "a")]), t)
    bad = spark.range(3).selectExpr("id", "cast(assert_true(id < 2) as string) as val")
    with pytest.raises(Exception):
        write_target(spark, bad, t)
    assert _as_dict(spark.read.parquet(f"{base}/t")) == {1: "a"}
    write_target(spark, _df(spark, [(2, "b")]), t)
    assert _as_dict(spark.read.parquet(f"{base}/t")) == {2: "b"}


def test_failed_table_overwrite_keeps_old_data(spark, base):
    t = _table(spark, base, write_mode="overwrite")
    write_target(spark, _df(spark, [(1, "a")]), t)
    bad = spark.range(3).selectExpr("id", "cast(assert_true(id < 2) as string) as val")
    with pytest.raises(Exception):
        write_target(spark, bad, t)
    assert _as_dict(spark.table(t.options["table"])) == {1: "a"}
    write_target(spark, _df(spark, [(2, "b"), (3, "c")]), t)
    assert _as_dict(spark.table(t.options["table"])) == {2: "b", 3: "c"}


def test_repeated_null_keys_are_not_duplicates(spark, base):
    t = _file(base, write_mode="merge", merge_keys=["id"])
    write_target(spark, _df(spark, [(None, "a"), (None, "b"), (1, "c")]), t)  # NULLs never match
    assert spark.read.parquet(f"{base}/t").count() == 3
    safe = TargetSpec("file", {"path": f"{base}/s"}, write_mode="merge", merge_keys=["id"], null_safe_keys=True)
    with pytest.raises(DuplicateMergeKeyError):
        write_target(spark, _df(spark, [(None, "a"), (None, "b")]), safe)


def test_table_half_done_swap_rolls_back(spark, base):
    from tidewater.sinks.tables import recover_table_target

    t = _table(spark, base, write_mode="merge", merge_keys=["id"], options={"commit": "rename"})
    write_target(spark, _df(spark, [(1, "a"), (2, "b")]), t)
    # died after moving the live folder aside (the stage table entry was already dropped)
    fs.rename(spark, f"{base}/t", f"{base}/t__old")
    assert recover_table_target(spark, t)
    assert _as_dict(spark.table(t.options["table"])) == {1: "a", 2: "b"}
    write_target(spark, _df(spark, [(2, "b2")]), t)
    assert _as_dict(spark.table(t.options["table"])) == {1: "a", 2: "b2"}


def test_table_stage_left_behind_is_reapplied(spark, base):
    from tidewater.sinks.tables import recover_table_target

    t = _table(spark, base, write_mode="merge", merge_keys=["id"], options={"commit": "copy"})
    write_target(spark, _df(spark, [(1, "a")]), t)
    stage = f"{t.options['table']}__stage_full"
    _df(spark, [(1, "a"), (2, "b")]).write.option("path", f"{base}/t__stage_full").saveAsTable(stage)
    assert recover_table_target(spark, t)
    assert _as_dict(spark.table(t.options["table"])) == {1: "a", 2: "b"}
    assert not spark.catalog.tableExists(stage)


def test_upsert_keeps_columns_present_in_some_files_only(spark, base):
    # appends with schema evolution leave files with and without column n
    write_target(spark, _df(spark, [(1, "a")]), _file(base))
    write_target(spark, _df(spark, [(2, "b", 5)], "id bigint, val string, n bigint"), _file(base))
    t = _file(base, write_mode="merge", merge_keys=["id"])
    write_target(spark, _df(spark, [(3, "c")]), t)
    rows = {r["id"]: (r["val"], r["n"]) for r in
            spark.read.option("mergeSchema", "true").parquet(f"{base}/t").collect()}
    assert rows == {1: ("a", None), 2: ("b", 5), 3: ("c", None)}


def test_partitioned_upsert_keeps_columns_of_later_partitions(spark, base):
    schema = "id bigint, val string, region string"
    write_target(spark, _df(spark, [(1, "a", "apac")], schema), _file(base, partition_columns=["region"]))
    write_target(spark, _df(spark, [(2, "b", 7, "eu")], "id bigint, val string, n bigint, region string"),
                 _file(base, partition_columns=["region"]))
    t = _file(base, write_mode="merge", merge_keys=["id", "region"], partition_columns=["region"])
    write_target(spark, _df(spark, [(3, "c", "eu")], schema), t)
    rows = {r["id"]: (r["val"], r["n"], r["region"]) for r in
            spark.read.option("mergeSchema", "true").parquet(f"{base}/t").collect()}
    assert rows == {1: ("a", None, "apac"), 2: ("b", 7, "eu"), 3: ("c", None, "eu")}


def test_partitioned_upsert_after_empty_first_batch(spark, base):
    schema = "id bigint, val string, region string"
    t = _file(base, write_mode="merge", merge_keys=["id"], partition_columns=["region"])
    write_target(spark, _df(spark, [], schema), t)
    write_target(spark, _df(spark, [(1, "a", "us")], schema), t)
    assert _as_dict(spark.read.parquet(f"{base}/t")) == {1: "a"}


def test_manifest_checksum_with_map_column(spark, base):
    df = spark.createDataFrame([(1, {"b": 2, "a": 1}), (2, {})], "id bigint, m map<string,int>")
    t = TargetSpec("file", {"path": f"{base}/t", "manifest_path": f"{base}/m"})
    write_target(spark, df, t)
    m = spark.read.json(f"{base}/m").first()
    assert m["row_count"] == 2 and m["checksum"] is not None


def test_empty_merge_batch_leaves_target_untouched(spark, base):
    t = _file(base, write_mode="merge", merge_keys=["id"])
    write_target(spark, _df(spark, [(1, "a")]), t)
    files = spark.read.parquet(f"{base}/t").inputFiles()
    report = write_target(spark, _df(spark, []), t, WriteContext(batch_rows=0))
    assert report.extra["scope"] == "empty" and spark.read.parquet(f"{base}/t").inputFiles() == files


def test_table_append_evolves_schema(spark, base):
    t = _table(spark, base)
    write_target(spark, _df(spark, [(1, "a")]), t)
    write_target(spark, _df(spark, [(2, "b", 7)], "id bigint, val string, n bigint"), t)
    rows = {r["id"]: (r["val"], r["n"]) for r in spark.table(t.options["table"]).collect()}
    assert rows == {1: ("a", None), 2: ("b", 7)}


def test_table_upsert_partitioned_outside_key_with_fewer_columns(spark, base):
    t = _table(spark, base, write_mode="merge", merge_keys=["id"], partition_columns=["region"])
    write_target(spark, _df(spark, [(1, "a", "us"), (2, "b", "eu")], "id bigint, val string, region string"), t)
    write_target(spark, _df(spark, [(2, "us")], "id bigint, region string"), t)  # no val column
    out = {r["id"]: (r["val"], r["region"]) for r in spark.table(t.options["table"]).collect()}
    assert out == {1: ("a", "us"), 2: (None, "us")}


def test_full_overwrite_ignores_session_dynamic_default(spark, base):
    schema = "id bigint, region string"
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        t = _file(base, write_mode="overwrite", partition_columns=["region"], options={"commit": "copy"})
        write_target(spark, _df(spark, [(1, "us"), (2, "eu")], schema), t)
        write_target(spark, _df(spark, [(3, "eu")], schema), t)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [(r["id"], r["region"]) for r in spark.read.parquet(f"{base}/t").collect()] == [(3, "eu")]


@pytest.mark.parametrize("partitioned", [False, True])
def test_insert_only_upsert_appends(spark, base, partitioned):
    schema = "id bigint, val string, region string"
    t = _file(base, write_mode="merge", merge_keys=["id"], partition_columns=["region"] if partitioned else [])
    write_target(spark, _df(spark, [(1, "a", "us"), (2, "b", "eu")], schema), t)
    before = set(spark.read.parquet(f"{base}/t").inputFiles())
    report = write_target(spark, _df(spark, [(3, "c", "eu")], schema), t)
    assert report.extra["scope"] == "insert"
    assert before <= set(spark.read.parquet(f"{base}/t").inputFiles())  # nothing rewritten
    # replaying the same batch finds its keys and merges: still one copy
    assert write_target(spark, _df(spark, [(3, "c", "eu")], schema), t).extra["scope"] != "insert"
    assert _as_dict(spark.read.parquet(f"{base}/t")) == {1: "a", 2: "b", 3: "c"}


def test_table_insert_only_upsert_appends(spark, base):
    t = _table(spark, base, write_mode="merge", merge_keys=["id"])
    write_target(spark, _df(spark, [(1, "a")]), t)
    assert write_target(spark, _df(spark, [(2, "b")]), t).extra["scope"] == "insert"
    assert write_target(spark, _df(spark, [(2, "b2")]), t).extra["scope"] == "static"
    assert _as_dict(spark.table(t.options["table"])) == {1: "a", 2: "b2"}


def test_warehouse_upsert_orchestration(spark):
    """Staging write then one MERGE and a DROP in the warehouse; the staging name carries the
    batch id. Spark's no-op sink stands in for the connector (no database is started)."""
    from tidewater.sinks.warehouse import warehouse_upsert

    statements = []
    target = TargetSpec("warehouse", {"table": "ORDERS", "format": "noop", "url": "jdbc:x"},
                        write_mode="merge", merge_keys=["id"])
    report = warehouse_upsert(spark, _df(spark, [(1, "a"), (2, "b")]), target, WriteContext(batch_id=42),
                              runner=lambda sp, opts, sql: statements.append((opts.get("url"), sql)))
    assert report.rows == 2 and report.extra["staging"] == "ORDERS_stage_42"
    assert statements == [
        ("jdbc:x", 'MERGE INTO ORDERS t USING ORDERS_stage_42 s ON t."id" = s."id" '
                   'WHEN MATCHED THEN UPDATE SET "val" = s."val" '
                   'WHEN NOT MATCHED THEN INSERT ("id", "val") VALUES (s."id", s."val")'),
        ("jdbc:x", "DROP TABLE ORDERS_stage_42"),
    ]


def test_warehouse_runner_quoting_and_named_stage(spark):
    from tidewater.sinks import warehouse as w
    from tidewater.spec import SNOWFLAKE_FORMAT

    assert w.statement_runner(TargetSpec("warehouse", {"format": SNOWFLAKE_FORMAT})) is w.connector_statement_runner
    assert w.statement_runner(TargetSpec("jdbc", {"url": "jdbc:x"})) is w.jdbc_statement_runner
    quotes = {u: w.identifier_quote(TargetSpec("jdbc", {"url": u}))("a") for u in ("jdbc:postgresql:x", "jdbc:mysql:x", "jdbc:sqlserver:x")}
    assert list(quotes.values()) == ['"a"', "`a`", "[a]"]
    seen = []
    target = TargetSpec("warehouse", {"table": "T", "format": "noop", "staging_table": "MINE"}, write_mode="merge", merge_keys=["id"])
    w.warehouse_upsert(spark, _df(spark, [(1, "a")]), target, WriteContext(), runner=lambda sp, o, sql: seen.append(sql))
    assert len(seen) == 1 and "USING MINE s" in seen[0]


def test_warehouse_append_and_overwrite_dispatch(spark):
    df = _df(spark, [(1, "a"), (2, "b")])
    for mode in ("append", "overwrite"):
        t = TargetSpec("snowflake", {"table": "T", "format": "noop"}, write_mode=mode)
        report = write_target(spark, df, t)
        assert (report.type, report.mode, report.rows, report.location) == ("snowflake", mode, 2, "T")


def _regions(spark):
    return spark.read.parquet("/root/testdata/sf0.001/nation.parquet").select("n_nationkey", "n_name", "n_regionkey")


def test_append_then_overwrite_of_a_table_slice(spark, base):
    nations = _regions(spark)
    for part in (nations.filter("n_regionkey < 2"), nations.filter("n_regionkey >= 2")):
        write_target(spark, part, _file(base))
    assert spark.read.parquet(f"{base}/t").exceptAll(nations).count() == 0
    write_target(spark, nations.limit(3), _file(base, write_mode="overwrite"))
    assert spark.read.parquet(f"{base}/t").count() == 3


@pytest.mark.parametrize("kind", ["file", "table"])
def test_upsert_replaces_and_adds(spark, base, kind):
    nations = _regions(spark)
    t = (_file if kind == "file" else lambda b, **k: _table(spark, b, **k))(base, write_mode="upsert", merge_keys=["n_nationkey"])
    write_target(spark, nations.filter("n_nationkey <= 15"), t)
    renamed = nations.filter("n_nationkey >= 10").selectExpr("n_nationkey", "lower(n_name) n_name", "n_regionkey")
    write_target(spark, renamed, t)
    out = spark.read.parquet(f"{base}/t") if kind == "file" else spark.table(t.options["table"])
    want = nations.filter("n_nationkey < 10").union(renamed)
    assert out.count() == want.count() and out.exceptAll(want).count() == 0


def test_registered_target(spark, base):
    from tidewater.sinks.logfmt import append_logfmt, overwrite_logfmt
    from tidewater.sources import read_source, register_source
    from tidewater.sources.logfmt import read_logfmt
    from tidewater.spec import FieldSpec, SourceSpec

    register_target("logfmt", append=append_logfmt, overwrite=overwrite_logfmt)
    register_source("logfmt", read_logfmt)
    odd = _df(spark, [(1, "a b=c&d", "x y"), (2, None, "x y"), (3, "", "é")], "id bigint, val string, part string")
    t = TargetSpec("logfmt", {"path": f"{base}/j"}, partition_columns=["part"])
    write_target(spark, odd, t)
    src = SourceSpec("logfmt", {"path": f"{base}/j"}, schema=[FieldSpec("id", "bigint"), FieldSpec("val", "string"), FieldSpec("part", "string")])
    assert read_source(spark, src).exceptAll(odd).count() == 0 and read_source(spark, src).count() == 3
    t.write_mode = "overwrite"
    write_target(spark, odd.limit(1), t)
    assert read_source(spark, src).count() == 1


def test_merge_into_an_empty_folder(spark, base):
    fs.mkdirs(spark, f"{base}/t")
    t = _file(base, write_mode="merge", merge_keys=["id"])
    write_target(spark, _df(spark, [(1, "a")]), t)
    assert _as_dict(spark.read.parquet(f"{base}/t")) == {1: "a"}


def test_first_merge_of_an_empty_batch_creates_the_target(spark, base):
    t = _file(base, write_mode="merge", merge_keys=["id"])
    write_target(spark, _df(spark, []), t, WriteContext(batch_rows=0))
    assert spark.read.parquet(f"{base}/t").columns == ["id", "val"]


def test_idempotent_append_is_refused_where_it_is_not_kept(spark, base):
    with pytest.raises(UnsupportedWriteModeError):
        write_target(spark, _df(spark, [(1, "a")]), TargetSpec("delta", {"path": f"{base}/d"}, idempotent=True))


def test_thousands_of_touched_partitions(spark):
    from tidewater.operators.upsert import touched_partitions

    rows = spark.range(9000).selectExpr("id", "cast(id % 75 as string) a", "cast(id % 40 as int) b")
    touched = touched_partitions(rows, ["a", "b"])
    assert len(touched.rows) == 600
    many = touched_partitions(rows.selectExpr("id", "cast(id as string) a", "cast(id % 3 as int) b"), ["a", "b"])
    assert len(many.rows) == 9000
    assert many.restrict(rows.selectExpr("cast(id as string) a", "cast((id + id % 2) % 3 as int) b")).count() < 9000


def test_warehouse_stage_goes_when_the_merge_fails(spark):
    from tidewater.sinks.warehouse import warehouse_upsert

    statements = []

    def failing(sp, opts, sql):
        statements.append(sql.split(" ")[0])
        if sql.startswith("MERGE"):
            raise RuntimeError("lock timeout")

    for named, want in ((None, ["MERGE", "DROP"]), ("MY_STAGE", ["MERGE"])):
        statements.clear()
        options = {"table": "ORDERS", "format": "noop", "url": "jdbc:x", **({"staging_table": named} if named else {})}
        with pytest.raises(RuntimeError, match="lock timeout"):
            warehouse_upsert(spark, _df(spark, [(1, "a")]), TargetSpec("warehouse", options, write_mode="merge", merge_keys=["id"]),
                             WriteContext(batch_id=1), runner=failing)
        assert statements == want


def test_delta_merge_counts(spark):
    from tidewater.sinks.delta import merge_counts

    schema = "version long, operation string, operationMetrics map<string,string>"
    one = spark.createDataFrame([(7, "MERGE", {"numTargetRowsUpdated": "3", "numTargetRowsInserted": "4", "numTargetRowsCopied": "90"})], schema)
    assert merge_counts(one) == {"rows": 7, "updated": 3, "inserted": 4, "copied": 90}
    assert merge_counts(spark.createDataFrame([(8, "WRITE", {})], schema))["rows"] == 0
    assert merge_counts(one.limit(0))["rows"] == 0
