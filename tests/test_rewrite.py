"""Upserts by file, by marked rows and by version, held against a dictionary."""
import itertools
import random

import pytest

from tidewater import fs
from tidewater.errors import SpecError
from tidewater.operators import upsert
from tidewater.operators.upsert import merge_by_version
from tidewater.session import unique_name
from tidewater.sinks import WriteContext, compact_marks, read_file_target, rewrite, write_target
from tidewater.sinks.files import recover_file_target
from tidewater.spec import TargetSpec

SCHEMA = "id bigint, val string"


def target(base, scope="files", keys=("id",), **kw):
    return TargetSpec("file", {"path": f"{base}/t", "rewrite": scope, **kw.pop("options", {})}, write_mode="merge",
                      merge_keys=list(keys), **kw)


def land(spark, t, n=1000, files=100):
    """``files`` files of consecutive ids."""
    spark.range(0, n, 1, files).selectExpr("id", "concat('v', id) AS val").write.parquet(t.options["path"])


def content(rows):
    out = {}
    for r in rows.collect():
        assert r["id"] not in out
        out[r["id"]] = r["val"]
    return out


def files_of(spark, t):
    return set(rewrite._staged_files(spark, t.options["path"]))


def test_one_key_rewrites_one_file(spark, base):
    t = target(base)
    land(spark, t, 1000, 500)
    before = files_of(spark, t)
    report = write_target(spark, spark.createDataFrame([(500, "x"), (5000, "new")], SCHEMA), t)
    after = files_of(spark, t)
    assert report.extra["scope"] == "files" and report.extra["replaced"] == 1 and report.rows == 3
    assert len(before) == 500 and len(before - after) == 1
    want = {i: f"v{i}" for i in range(1000)} | {500: "x", 5000: "new"}
    assert content(spark.read.parquet(t.options["path"])) == want


def test_key_range_reaches_the_scan(spark, base):
    t = target(base)
    land(spark, t)
    batch = spark.createDataFrame([(17, "x"), (20, "y")], SCHEMA)
    rows = rewrite.in_key_range(spark.read.parquet(t.options["path"]), batch, ["id"]).select("id", "_metadata.file_path")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,17)" in plan and "LessThanOrEqual(id,20)" in plan and "val" not in plan


@pytest.mark.parametrize("scope", ["files", "marks"])
@pytest.mark.parametrize("parted", [False, True])
def test_random_batches(spark, base, scope, parted):
    """Keys move between partitions, come with nulls, and are new or known."""
    r = random.Random(7)
    t = target(base, scope, partition_columns=["val"] if parted else [])
    parts = ["a", "b/c", "d=%é", "e f", "g+h"]
    want = {}
    for step in range(4):
        ids = r.sample(range(40), 12) if step else list(range(25))
        batch = {i: r.choice(parts) for i in ids}
        rows = list(batch.items()) + ([(None, "a")] if step == 2 else [])
        write_target(spark, spark.createDataFrame(rows, SCHEMA).repartition(4), t, WriteContext(batch_rows=len(rows)))
        want |= batch
        got = read_file_target(spark, t, spark.read.parquet(t.options["path"]).schema)
        nulls = got.filter("id IS NULL").count()
        assert nulls == (1 if step >= 2 else 0)
        assert content(got.filter("id IS NOT NULL")) == want
    if scope == "marks":
        compact_marks(spark, t)
        assert not rewrite.mark_commits(spark, t.options["path"])
        assert content(spark.read.parquet(t.options["path"]).filter("id IS NOT NULL")) == want


def test_marks_write_in_proportion_to_the_batch(spark, base):
    t = target(base, "marks")
    land(spark, t)
    before = files_of(spark, t)
    for k in range(3):
        report = write_target(spark, spark.createDataFrame([(5, f"x{k}"), (2000 + k, "n")], SCHEMA).coalesce(1), t)
        assert report.rows == 2 and report.extra["marked"] == 1
    assert before < files_of(spark, t) and len(files_of(spark, t)) == len(before) + 3
    got = content(read_file_target(spark, t))
    assert got[5] == "x2" and len(got) == 1003
    assert compact_marks(spark, t) == 3  # the landed file and two of the added ones
    assert content(spark.read.parquet(t.options["path"])) == got
    assert compact_marks(spark, t) == 0


@pytest.mark.parametrize("scope", ["files", "marks"])
@pytest.mark.parametrize("stop", [0, 1, 3, 5])
def test_interrupted_moves_are_finished(spark, base, scope, stop, monkeypatch):
    """A run dies before its n-th file operation after the list is written."""
    t = target(base, scope)
    land(spark, t, 100, 5)
    batch = spark.createDataFrame([(1, "x"), (55, "y"), (99, "z"), (700, "n")], SCHEMA)
    want = {i: f"v{i}" for i in range(100)} | {1: "x", 55: "y", 99: "z", 700: "n"}
    calls = itertools.count()

    def failing(real):
        def run(*args):
            if rewrite.read_plan(spark, t.options["path"]) and next(calls) == stop:
                raise RuntimeError("died")
            return real(*args)
        return run

    with monkeypatch.context() as m:
        m.setattr(fs, "rename", failing(fs.rename))
        m.setattr(fs, "delete", failing(fs.delete))
        try:
            write_target(spark, batch, t)
        except RuntimeError:
            if scope == "marks":  # as before until the list is done
                assert content(read_file_target(spark, t))[55] == "v55"
    recover_file_target(spark, t)
    assert content(read_file_target(spark, t)) == want
    assert not fs.exists(spark, rewrite.stage_path(t.options["path"])) and rewrite.read_plan(spark, t.options["path"]) is None
    write_target(spark, batch, t)  # a replay changes nothing
    assert content(read_file_target(spark, t)) == want


def test_stage_without_a_list_is_discarded(spark, base):
    t = target(base)
    land(spark, t, 10, 2)
    spark.range(3).write.parquet(f"{rewrite.stage_path(t.options['path'])}/data")
    assert not recover_file_target(spark, t)
    assert not fs.exists(spark, rewrite.stage_path(t.options["path"]))


def test_fewer_and_more_columns(spark, base):
    t = target(base)
    land(spark, t, 20, 4)
    write_target(spark, spark.createDataFrame([(3,)], "id bigint"), t)
    assert content(spark.read.parquet(t.options["path"]))[3] is None
    report = write_target(spark, spark.createDataFrame([(4, "x", 1)], SCHEMA + ", extra int"), t)
    assert report.extra["scope"] != "files"  # all files get the new column
    got = {r["id"]: r["extra"] for r in spark.read.parquet(t.options["path"]).collect()}
    assert got[4] == 1 and got[3] is None and len(got) == 20


def test_overwrite_drops_marks(spark, base):
    t = target(base, "marks")
    land(spark, t, 10, 2)
    write_target(spark, spark.createDataFrame([(3, "x")], SCHEMA), t)
    over = TargetSpec("file", dict(t.options), write_mode="overwrite")
    write_target(spark, spark.createDataFrame([(1, "a")], SCHEMA), over)
    assert content(read_file_target(spark, t)) == {1: "a"}


def test_table_by_files(spark, base):
    t = TargetSpec("table", {"table": unique_name("t"), "path": f"{base}/t", "rewrite": "files"}, write_mode="merge",
                   merge_keys=["id"])
    write_target(spark, spark.range(0, 100, 1, 20).selectExpr("id", "concat('v', id) AS val"), t)
    report = write_target(spark, spark.createDataFrame([(7, "x"), (300, "n")], SCHEMA), t)
    assert report.extra["scope"] == "files" and report.extra["replaced"] == 1
    got = content(spark.table(t.options["table"]))
    assert len(got) == 101 and got[7] == "x"


def test_refused_options(spark, base):
    df = spark.createDataFrame([(1, "a")], SCHEMA)
    with pytest.raises(SpecError):
        write_target(spark, df, target(base, "rows"))
    with pytest.raises(SpecError):
        write_target(spark, df, target(base, "marks", options={"format": "orc"}))
    with pytest.raises(SpecError):
        write_target(spark, df, TargetSpec("table", {"table": unique_name("t"), "rewrite": "marks"}, write_mode="merge",
                                           merge_keys=["id"]))
    with pytest.raises(SpecError):
        write_target(spark, df, target(base, options={"version_column": "missing"}))


VERSIONED = "id bigint, val string, at int"


@pytest.mark.parametrize("kind", ["partitions", "files", "marks", "parted", "table"])
def test_batches_in_any_order_give_one_result(spark, base, kind):
    batches = [[(1, "a1", 1), (2, "a1", 5)], [(1, "b2", 2), (1, "b1", 1), (3, "b", None)],
               [(2, "c4", 4), (3, "c", 1), (1, "b2x", 2)]]
    results = []
    orders = list(itertools.permutations(batches))
    for k, order in enumerate(orders if kind == "files" else [orders[0], orders[-1]]):
        if kind == "table":
            t = TargetSpec("table", {"table": unique_name("t"), "path": f"{base}/t{k}"}, write_mode="merge", merge_keys=["id"])
        else:
            t = target(f"{base}/{k}", "partitions" if kind == "parted" else kind,
                       partition_columns=["val"] if kind == "parted" else [])
        t.options["version_column"] = "at"
        for rows in [*order, order[0]]:
            write_target(spark, spark.createDataFrame(rows, VERSIONED), t)
        got = spark.table(t.options["table"]) if kind == "table" else read_file_target(
            spark, t, spark.read.parquet(t.options["path"]).schema)
        results.append(sorted((r["id"], r["val"], r["at"]) for r in got.collect()))
    assert all(r == results[0] for r in results)
    assert [(r[0], r[2]) for r in results[0]] == [(1, 2), (2, 5), (3, 1)]


def test_version_keeps_rows_with_null_keys(spark, base):
    t = target(base, options={"version_column": "at"})
    write_target(spark, spark.createDataFrame([(None, "a", 1), (None, "b", 2), (1, "c", 1)], VERSIONED), t)
    write_target(spark, spark.createDataFrame([(None, "d", 1), (1, "old", 0)], VERSIONED), t)
    assert sorted(r["val"] for r in spark.read.parquet(t.options["path"]).collect()) == ["a", "b", "c", "d"]


@pytest.mark.parametrize("null_safe", [False, True])
def test_merge_by_version_is_the_same_by_broadcast_and_by_shuffle(spark, null_safe):
    """Repeated keys of the target stay unless the batch has them; null keys, fewer and more columns."""
    r = random.Random(3)
    held = [(r.choice([None, *range(30)]), r.choice("xy"), r.choice([None, 1, 2, 3])) for _ in range(60)]
    new = {i: (i, r.choice("xyz"), r.choice([None, 1, 2, 3, 4]), "e") for i in range(20, 50)}
    batch = [*new.values(), (None, "n", 2, "e")]
    existing = spark.createDataFrame(held, VERSIONED)
    frame = spark.createDataFrame(batch, VERSIONED + ", extra string").drop("val")
    got = [sorted(map(repr, merge_by_version(existing, frame, ["id"], ["at"], null_safe, b).collect())) for b in (False, True)]
    assert got[0] == got[1]
    rows = merge_by_version(existing, frame, ["id"], ["at"], null_safe).collect()
    for i in (*range(50), None):
        mine = sorted((x["at"] is not None, x["at"] or 0) for x in rows if x["id"] == i)
        old = sorted((x[2] is not None, x[2] or 0) for x in held if x[0] == i)
        late = [(x[2] is not None, x[2] or 0) for x in batch if x[0] == i]
        assert mine == (old if not late else sorted(old + late) if i is None and not null_safe else [max(old + late)])


def test_merge_by_version_shuffles_each_side_once(spark, tmp_path):
    spark.range(100).selectExpr("id", "cast(id as string) AS val", "1 AS at").write.parquet(str(tmp_path / "t"))
    existing = spark.read.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = merge_by_version(existing, existing, ["id"], ["at"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


@pytest.mark.parametrize("kind", ["partitions", "files", "marks", "parted", "table"])
def test_batches_too_large_for_a_broadcast_give_the_same(spark, base, kind, monkeypatch):
    monkeypatch.setattr(upsert, "SMALL_KEYS", -1)
    test_batches_in_any_order_give_one_result(spark, base, kind)


@pytest.mark.parametrize("scope", ["partitions", "files"])
def test_catalog_learns_the_touched_partitions(spark, base, scope):
    """What is registered after each upsert equals a full repair of the table."""
    t = TargetSpec("table", {"table": unique_name("t"), "path": f"{base}/t", "rewrite": scope}, write_mode="merge",
                   merge_keys=["id"], partition_columns=["val"])
    table = t.options["table"]

    def known():
        return {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}

    for rows in ([(1, "a"), (2, "b/c"), (3, "it's"), (4, None)], [(2, "a"), (5, "new \\ one")], [(9, "only=new")], [(4, "a"), (3, "x")]):
        write_target(spark, spark.createDataFrame(rows, SCHEMA), t)
        now = known()
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        assert now == known()
    assert {r["id"]: r["val"] for r in spark.table(table).collect()} == {1: "a", 2: "a", 3: "x", 4: "a", 5: "new \\ one", 9: "only=new"}
