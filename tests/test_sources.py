import datetime as dt

import pytest

from tidewater.errors import MissingOptionError, UnknownConnectorError
from tidewater.functions import typed
from tidewater.session import unique_name
from tidewater.sources import (decode_json_value, read_incremental, read_source, register_source)
from tidewater.sources.jdbc import jdbc_options
from tidewater.spec import FieldSpec, SourceSpec


def test_required_options(spark):
    for src in (SourceSpec("parquet", {}), SourceSpec("table", {}), SourceSpec("jdbc", {}),
                SourceSpec("delta", {})):
        with pytest.raises(MissingOptionError):
            read_source(spark, src)
    with pytest.raises(UnknownConnectorError):
        read_source(spark, SourceSpec("nope", {}))


def test_table_and_partition_filter(spark, base):
    from tidewater.session import unique_name

    t = unique_name("src")
    spark.createDataFrame([(1, "us"), (2, "eu")], "id bigint, region string").write \
        .option("path", base).partitionBy("region").saveAsTable(t)
    assert read_source(spark, SourceSpec("hive", {"table": t})).count() == 2
    df = read_source(spark, SourceSpec("table", {"table": t, "partition_filter": "region = 'eu'"}))
    assert [r["id"] for r in df.collect()] == [2]
    assert "PartitionFilters: [isnotnull(region" in df._jdf.queryExecution().executedPlan().toString()


def test_incremental_string_column(spark, base):
    spark.createDataFrame([(1, "2026-01-01"), (2, "2026-02-01"), (3, "2026-03-01")],
                          "id bigint, updated_at string").write.parquet(base)
    src = SourceSpec("parquet", {"path": base}, watermark_column="updated_at")
    assert read_incremental(spark, src, ("2026-01-15", "string")).count() == 2
    assert read_incremental(spark, src, None).count() == 3


def test_incremental_filter_is_pushed(spark):
    src = SourceSpec("parquet", {"path": "/root/testdata/sf0.001/orders.parquet"}, watermark_column="o_orderdate")
    df = read_incremental(spark, src, ("1998-01-01 00:00:00", "timestamp_ntz"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate,1998-01-01T00:00)]" in plan


def test_zoned_watermark_survives_time_zone_change(spark):
    ts = dt.datetime(2026, 3, 1, 12, 0, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([(ts,)], "t timestamp")
    text = df.select(typed.render(df["t"], df.schema["t"].dataType)).first()[0]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert df.filter(typed.after(df["t"], text, "timestamp")).count() == 0
            assert df.filter(typed.after(df["t"], text, "timestamp", inclusive=True)).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("ddl,value", [("bigint", 10), ("double", 0.1), ("date", dt.date(2026, 1, 2)),
                                       ("decimal(10,2)", None), ("timestamp_ntz", dt.datetime(2026, 1, 1, 5))])
def test_typed_round_trip(spark, ddl, value):
    df = spark.createDataFrame([(value,)], f"v {ddl}") if value is not None else \
        spark.sql("SELECT CAST(12.34 AS DECIMAL(10,2)) AS v")
    text = df.select(typed.render(df["v"], df.schema["v"].dataType)).first()[0]
    assert df.filter(typed.after(df["v"], text, ddl, inclusive=True)).count() == 1
    assert df.filter(typed.after(df["v"], text, ddl)).count() == 0


def test_registered_custom_source(spark):
    register_source("dummy", lambda sp, s: sp.createDataFrame([(1,)], "id bigint"))
    assert read_source(spark, SourceSpec("dummy", {})).count() == 1


def test_decode_json_value(spark):
    raw = spark.createDataFrame(
        [(b'{"a": 1, "b": {"c": "x"}}', 1), (b"not json", 2), (None, 3), (b'{"zz": 5}', 4)],
        "value binary, offset bigint")
    schema = {"type": "struct", "fields": [
        {"name": "a", "type": "long", "nullable": True, "metadata": {}},
        {"name": "b", "type": {"type": "struct", "fields": [
            {"name": "c", "type": "string", "nullable": True, "metadata": {}}]}, "nullable": True, "metadata": {}}]}
    plain = decode_json_value(raw, schema)
    assert plain.columns == ["a", "b"]
    rows = {r["offset"]: r for r in decode_json_value(raw, schema, keep=["offset"], flag_column="_bad").collect()}
    assert rows[1]["a"] == 1 and rows[1]["b"]["c"] == "x" and not rows[1]["_bad"]
    assert all(rows[k]["_bad"] and rows[k]["a"] is None for k in (2, 3, 4))


def test_jdbc_options():
    opts = jdbc_options({"url": "jdbc:x", "query": "select 1", "user": "u"})
    assert opts == {"url": "jdbc:x", "user": "u", "query": "select 1"}
    part = jdbc_options({"url": "jdbc:x", "query": "select * from t", "partition_column": "id",
                         "lower_bound": 0, "upper_bound": 10, "num_partitions": 4})
    assert part["dbtable"] == "(select * from t) src" and part["partitionColumn"] == "id"
    assert part["numPartitions"] == "4" and "query" not in part
    assert jdbc_options({"url": "jdbc:x", "dbtable": "t"})["dbtable"] == "t"


def test_secret_references(monkeypatch, tmp_path):
    from tidewater.errors import SpecError
    from tidewater.secrets import resolve_options
    from tidewater.sinks.warehouse import connection_options
    from tidewater.spec import TargetSpec

    monkeypatch.setenv("TW_TEST_PW", "s3cret")
    assert jdbc_options({"url": "jdbc:x", "dbtable": "t", "password_secret": "env:TW_TEST_PW"})["password"] == "s3cret"
    secret_file = tmp_path / "pw"
    secret_file.write_text("from-file\n")
    opts = connection_options(TargetSpec("snowflake", {"table": "T", "sfPassword_secret": f"file:{secret_file}"}))
    assert opts == {"sfPassword": "from-file"}
    with pytest.raises(SpecError):
        resolve_options({"password_secret": "vault:x"})


@pytest.mark.parametrize("kind", ["parquet", "csv", "json"])
def test_file_formats_round_trip(spark, base, kind):
    parts = spark.read.parquet("/root/testdata/sf0.001/supplier.parquet")
    writer = parts.write.option("header", True) if kind == "csv" else parts.write
    writer.format(kind).save(base)
    fields = [FieldSpec(f.name, f.dataType.simpleString()) for f in parts.schema.fields]
    df = read_source(spark, SourceSpec(kind, {"path": base}, schema=fields))
    assert df.dtypes == parts.dtypes and df.exceptAll(parts).count() == 0 and df.count() == parts.count()
    assert set(read_source(spark, SourceSpec(kind, {"path": base})).columns) == set(parts.columns)


def test_partition_filter_is_checked_against_the_partitions(spark, base, caplog):
    t = unique_name("parts")
    spark.range(10).selectExpr("id", "id % 3 AS part").write.partitionBy("part").option("path", f"{base}/p").saveAsTable(t)
    with caplog.at_level("WARNING", logger="tidewater.sources"):
        assert read_source(spark, SourceSpec("table", {"table": t, "partition_filter": "part = 1"})).count() == 3
        assert not caplog.records
        assert read_source(spark, SourceSpec("table", {"table": t, "partition_filter": "part = 1 AND id > 4"})).count() == 1
        assert "partitions it keeps" in caplog.text
