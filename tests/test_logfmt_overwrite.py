"""An overwritten custom target is read back whole."""
from tidewater.queries import ORDERS_FIELDS, _write_logfmt
from tidewater.sources import SourceSpec, read_source, register_source
from tidewater.sources.logfmt import read_logfmt

SF = "/root/testdata/sf0.001"


def test_every_column_after_an_overwrite(spark):
    path = _write_logfmt(spark, SF, "logfmt_overwrite")
    _write_logfmt(spark, SF, "logfmt_overwrite", "overwrite", path)
    register_source("logfmt", read_logfmt)
    got = read_source(spark, SourceSpec("logfmt", {"path": path}, schema=ORDERS_FIELDS))
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assert sorted(got.columns) == sorted(orders.columns)
    assert sorted(map(tuple, got.select(orders.columns).collect())) == sorted(map(tuple, orders.collect()))
