"""Compound marks and late rows."""
import pytest
from pyspark.sql import functions as F

from tidewater import spec_from_dict
from tidewater.errors import SpecError
from tidewater.functions import typed
from tidewater.plans import prepare_batch, run
from tidewater.plans import state as st

DDL = "id bigint, at date, val string"


def land(spark, base, rows):
    df = spark.createDataFrame(rows, "id bigint, at string, val string")
    df.withColumn("at", F.col("at").cast("date")).coalesce(1).write.mode("append").parquet(f"{base}/in")


def spec(base, mode="append", **source):
    target = {"type": "file", "options": {"path": f"{base}/out"}, "write_mode": mode}
    return spec_from_dict({
        "dataset_name": "ds", "targets": [{**target, "merge_keys": ["id"]} if mode == "merge" else target],
        "source": {"type": "parquet", "options": {"path": f"{base}/in"}, "watermark_column": "at", **source},
        "data_quality": {"skip_if_empty": True}, "state_path": f"{base}/state", "audit_path": f"{base}/audit"})


def ids(spark, base):
    return sorted(r["id"] for r in spark.read.parquet(f"{base}/out").collect())


def test_rows_that_tie_with_the_mark_are_read_once(spark, base):
    s = spec(base, watermark_tie_column="id")
    land(spark, base, [(1, "2024-01-01", "a"), (2, "2024-01-02", "b"), (3, "2024-01-02", "c")])
    run(spark, s)
    land(spark, base, [(4, "2024-01-02", "tie"), (5, "2024-01-03", "d"), (6, None, "no mark")])
    b = prepare_batch(spark, s, recover=False)
    plan = b.df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at,2024-01-02)" in plan
    assert run(spark, s).row_count == 2
    assert run(spark, s).skipped
    assert ids(spark, base) == [1, 2, 3, 4, 5]
    value = st.read_state(spark, f"{base}/state", "ds", ["file"])["file"]
    assert value.type == "struct<mark:date,tie:bigint>" and '"2024-01-03"' in value.value


def test_a_plain_mark_becomes_a_compound_one(spark, base):
    land(spark, base, [(1, "2024-01-01", "a"), (2, "2024-01-02", "b")])
    run(spark, spec(base))
    land(spark, base, [(3, "2024-01-02", "was skipped by the plain mark"), (4, "2024-01-03", "c")])
    run(spark, spec(base, watermark_tie_column="id"))
    land(spark, base, [(5, "2024-01-03", "tie")])
    run(spark, spec(base, watermark_tie_column="id"))
    assert ids(spark, base) == [1, 2, 4, 5]


def test_compound_marks_compare(spark):
    kind = "struct<mark:timestamp,tie:bigint>"
    df = spark.sql("SELECT * FROM VALUES (timestamp'2024-01-01', 5L), (timestamp'2024-01-01', 6L), (timestamp'2024-01-02', 1L), "
                   "(CAST(NULL AS timestamp), 9L), (timestamp'2024-01-01', CAST(NULL AS bigint)) AS t(at, id)")
    one = df.filter("id = 5").select(typed.mark_value("at", "id").alias("m"))
    text = one.select(typed.render(F.col("m"), one.schema["m"].dataType)).first()[0]
    got = df.filter(typed.past(df["at"], df["id"], (text, kind))).collect()
    assert sorted(r["id"] for r in got) == [1, 6]
    assert len(df.filter(typed.past(df["at"], df["id"], (text, kind), True)).collect()) == 3
    flags = spark.range(1).select(typed.newer((text, kind), (text, kind)), typed.newer((text, kind), ("0", "timestamp"))).first()
    assert tuple(flags) == (False, True)
    top = df.agg(F.max(typed.mark_value("at", "id")).alias("m")).first()["m"]
    assert top["tie"] == 1


def test_late_rows_come_from_new_files(spark, base):
    s = spec(base, "merge", late_rows="new_files", late_margin_seconds=0)
    land(spark, base, [(1, "2024-01-05", "a"), (2, "2024-01-06", "b")])
    run(spark, s)
    land(spark, base, [(3, "2024-01-01", "late"), (4, None, "no mark")])
    b = prepare_batch(spark, s, recover=False)
    assert sorted(r["id"] for r in b.df.collect()) == [3, 4]
    read = b.df._jdf.queryExecution().executedPlan().toString()
    assert "file_modification_time" in read
    second = run(spark, s)
    assert second.row_count == 2 and ids(spark, base) == [1, 2, 3, 4]
    assert st.read_state(spark, f"{base}/state", "ds", ["file"])["file"].value == "2024-01-06"  # it does not go back
    land(spark, base, [(5, "2024-01-09", "c"), (1, "2024-01-02", "late change")])
    assert run(spark, s).row_count == 2
    got = {r["id"]: r["val"] for r in spark.read.parquet(f"{base}/out").collect()}
    assert got == {1: "late change", 2: "b", 3: "late", 4: "no mark", 5: "c"}


@pytest.mark.parametrize("mode,source", [("append", {"late_rows": "new_files"}), ("merge", {"late_rows": "often"}),
                                         ("merge", {"late_rows": "new_files", "type": "jdbc"}),
                                         ("merge", {"watermark_column": None, "watermark_tie_column": "id"})])
def test_refused_specs(base, mode, source):
    with pytest.raises(SpecError):
        spec(base, mode, **source)
