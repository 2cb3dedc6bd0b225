"""Column transforms and deduplication on slices of the given tables."""
import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewater.errors import SpecError
from tidewater.operators import (add_metadata, apply_chain, cast_columns, compile_chain, dedup_any,
                                 dedup_latest, drop_columns, rename_columns)
from tidewater.spec import TransformSpec

SF = "/root/testdata/sf0.001"
METHODS = pytest.mark.parametrize("method", ["window", "agg"])


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet")


@pytest.fixture(scope="module")
def nations(spark):
    return spark.read.parquet(f"{SF}/nation.parquet")


def test_rename_keeps_order_and_swaps(nations):
    names = nations.columns
    out = rename_columns(nations, {names[0]: names[1], names[1]: names[0], "no_such": "x"})
    assert out.columns == [names[1], names[0], *names[2:]]
    assert [tuple(r) for r in out.collect()] == [tuple(r) for r in nations.collect()]
    with pytest.raises(SpecError):
        rename_columns(nations, {names[0]: names[1]})


def test_names_follow_the_sessions_case_rule(spark, nations):
    first = nations.columns[0]
    assert rename_columns(nations, {first.upper(): "Key"}).columns[0] == "Key"
    assert dict(cast_columns(nations, {first.upper(): "string"}).dtypes)[first] == "string"
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert rename_columns(nations, {first.upper(): "Key"}).columns == nations.columns
        with pytest.raises(SpecError):
            cast_columns(nations, {first.upper(): "string"})
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_cast_nulls_or_raises(orders):
    out = cast_columns(orders, {"o_orderstatus": "int", "o_totalprice": "decimal(18,2)"})
    assert out.filter("o_orderstatus is not null").count() == 0
    assert dict(out.dtypes)["o_totalprice"] == "decimal(18,2)" and out.columns == orders.columns
    with pytest.raises(PySparkException):
        cast_columns(orders, {"o_orderstatus": "int"}, on_error="fail").collect()
    with pytest.raises(SpecError):
        cast_columns(orders, {"o_nothing": "int"})


def test_metadata_is_one_constant_per_run(orders):
    out = add_metadata(orders.repartition(3), "sales", dt.datetime(2025, 5, 4, 3, 2, 1, tzinfo=dt.timezone.utc))
    assert [tuple(r) for r in out.select(F.col("_ingested_at").cast("string"), "_dataset_name").distinct().collect()] == [
        ("2025-05-04 03:02:01", "sales")]


def test_drop_ignores_unknown_names(orders):
    assert drop_columns(orders, ["o_orderpriority", "o_nothing"]).columns == [c for c in orders.columns if c != "o_orderpriority"]


@METHODS
def test_latest_per_customer(orders, method):
    got = {r.o_custkey: r.o_orderkey for r in
           dedup_latest(orders, ["o_custkey"], "o_orderdate", "o_orderkey", method=method).collect()}
    best = {}
    for r in orders.collect():
        best[r.o_custkey] = max(best.get(r.o_custkey, (r.o_orderdate, -1)), (r.o_orderdate, r.o_orderkey))
    assert got == {k: v[1] for k, v in best.items()}


@METHODS
def test_null_orders_lose_and_ties_fall_to_the_next_column(orders, method):
    blank = orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate")))
    flat = dedup_latest(blank.withColumn("same", F.lit(1)), ["o_custkey"], ["same"], ["o_orderkey"], method=method)
    top = orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("o_orderkey"))
    assert flat.select("o_custkey", "o_orderkey").exceptAll(top).count() == 0
    kept = dedup_latest(blank, ["o_custkey"], "o_orderdate", "o_orderkey", method=method)
    some = blank.filter("o_orderdate is not null").select("o_custkey").distinct()
    assert kept.filter("o_orderdate is null").join(some, "o_custkey", "left_semi").count() == 0


@METHODS
def test_awkward_names_and_case(spark, method):
    df = spark.createDataFrame([(7, 1, "x"), (7, 4, "y"), (8, 2, "z")], "`Key.id` bigint, `at time` bigint, `p.q` string")
    out = dedup_latest(df, ["key.ID"], "AT time", method=method)
    assert sorted(tuple(r) for r in out.collect()) == [(7, 4, "y"), (8, 2, "z")]
    with pytest.raises(SpecError):
        dedup_latest(df, ["nokey"], "at time", method=method)


def test_one_row_per_key(orders):
    keys = orders.select("o_custkey").distinct().count()
    assert dedup_any(orders, ["O_CUSTKEY"]).count() == keys


def test_chain_runs_in_order(orders):
    specs = [TransformSpec("rename", {"mapping": {"o_custkey": "buyer"}}),
             TransformSpec("deduplicate", {"keys": ["buyer"], "order_by": "o_totalprice", "tie_breakers": ["o_orderkey"]}),
             TransformSpec("add_metadata", {}), TransformSpec("drop", {"columns": ["_ingested_at", "o_orderstatus"]})]
    out = apply_chain(orders, compile_chain(specs, "sales", dt.datetime(2025, 5, 4)))
    assert out.count() == orders.select("o_custkey").distinct().count()
    assert {"buyer", "_dataset_name"} <= set(out.columns) and "o_orderstatus" not in out.columns
    with pytest.raises(SpecError):
        compile_chain([TransformSpec("unheard_of", {})], "sales", dt.datetime(2025, 5, 4))
