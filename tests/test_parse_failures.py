"""Records that do not parse, field by field, in batch and streaming runs."""
import pytest

from tidewater import fs
from tidewater.errors import SpecError
from tidewater.plans import run
from tidewater.plans import state as st
from tidewater.sources import decode_json_value, read_source
from tidewater.sources.parsing import RAW, UNPARSED, split_unparsed
from tidewater.spec import FieldSpec, SourceSpec, spec_from_dict
from tidewater.streaming import run_available_now

FIELDS = [{"name": "id", "type": "bigint"}, {"name": "at", "type": "timestamp_ntz"}, {"name": "price", "type": "double"},
          {"name": "note", "type": "string"}]


def lines(spark, path, texts, name="f"):
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("append").text(path)


def source(kind, path, **options):
    return SourceSpec(kind, {"path": path, **options}, schema=[FieldSpec(**f) for f in FIELDS], on_parse_error="quarantine")


CSV = ['1,2024-01-01 00:00:00,1.5,ok', '2,yesterday,2.5,bad date', '3,2024-01-03 00:00:00,cheap,bad price',
       'x,y,z,all bad', '5,2024-01-05 00:00:00', '6,2024-01-06 00:00:00,,empty price', '7,2024-01-07 00:00:00,1,"a;b,c"',
       '8,2024-01-08 00:00:00,1,more,tokens']
JSON = ['{"id": 1, "at": "2024-01-01 00:00:00", "price": 1.5, "note": "ok"}', '{"id": "two", "price": 2.0}', '{"id": 3, "price": "n/a"}',
        'not json', '{"id": 5}', '{"id": 6, "note": {"a": 1}}', '[1, 2]']


def failed(df):
    _, bad = split_unparsed(df)
    return {r[RAW]: tuple(r[UNPARSED]) for r in bad.collect()}


def test_csv_fields(spark, base):
    lines(spark, f"{base}/in", CSV)
    df = read_source(spark, source("csv", f"{base}/in", header="false"))
    assert failed(df) == {CSV[1]: ("at",), CSV[2]: ("price",), CSV[3]: ("id", "at", "price"), CSV[4]: ("*",), CSV[7]: ("*",)}
    good, bad = split_unparsed(df)
    assert good.columns == [f["name"] for f in FIELDS]
    assert {r["id"] for r in good.collect()} == {1, 6, 7}
    # no column selection changes which records fail
    assert good.select("note").count() == good.count() == 3 and bad.select("id").count() == 5


def test_csv_options_reach_the_second_parse(spark, base):
    texts = ["1|2024-01-01 00:00:00|'a|b'|x", "2|2024-01-02 00:00:00|NONE|'p|q'"]
    lines(spark, f"{base}/in", texts)
    df = read_source(spark, source("csv", f"{base}/in", header="false", sep="|", quote="'", nullValue="NONE"))
    assert failed(df) == {texts[0]: ("price",)}


def test_json_fields(spark, base):
    lines(spark, f"{base}/in", JSON)
    df = read_source(spark, source("json", f"{base}/in"))
    assert failed(df) == {JSON[1]: ("id",), JSON[2]: ("price",), JSON[3]: ("*",), JSON[6]: ("*",)}
    good, _ = split_unparsed(df)
    assert {r["id"]: r["note"] for r in good.collect()} == {1: "ok", 5: None, 6: '{"a": 1}'}


def test_message_fields(spark):
    texts = [*JSON, None, "{}", ""]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "offset int, value string")
    out = decode_json_value(rows, "id bigint, price double, note string", keep=["offset"], flag_column="bad", failures=True)
    got = {r["offset"]: (r["bad"], tuple(r[UNPARSED]), r[RAW]) for r in out.collect()}
    assert {k: v[1] for k, v in got.items() if v[0]} == {1: ("id",), 2: ("price",), 3: ("*",), 6: ("*",), 7: ("*",), 8: ("*",),
                                                         9: ("*",)}
    assert got[1][2] == JSON[1] and got[7][2] == "" and got[0][2] is None
    # one bad field of several is enough for the flag alone
    flagged = decode_json_value(rows, "id bigint, price double, note string", keep=["offset"], flag_column="bad")
    assert {r["offset"] for r in flagged.filter("bad").collect()} == {k for k, v in got.items() if v[0]}


def spec(base, **over):
    raw = {"dataset_name": "ds", "source": {"type": "csv", "options": {"path": f"{base}/in", "header": "false"}, "schema": FIELDS,
                                            "on_parse_error": "quarantine", "watermark_column": "at"},
           "transforms": [{"type": "deduplicate", "keys": ["id"], "order_by": "at"}],
           "targets": [{"type": "file", "options": {"path": f"{base}/out"}, "write_mode": "merge", "merge_keys": ["id"]}],
           "quarantine": {"path": f"{base}/dlq"}, "state_path": f"{base}/state", "audit_path": f"{base}/audit"}
    raw.update(over)
    return spec_from_dict(raw)


def test_run_loads_the_rest_and_keeps_failures(spark, base):
    lines(spark, f"{base}/in", CSV + ["1,2030-01-01 00:00:00,never,newer but broken"])
    result = run(spark, spec(base))
    assert result.row_count == 3 and result.quarantine_path == f"{base}/dlq/ds_unparsed"
    got = {r["id"]: r["note"] for r in spark.read.parquet(f"{base}/out").collect()}
    assert got == {1: "ok", 6: "empty price", 7: "a;b,c"}  # the broken row wins no deduplication
    bad = spark.read.parquet(f"{base}/dlq/ds_unparsed")
    assert bad.count() == 6 and bad.filter("_dlq_reason = 'unparsed: at'").first()["_dlq_raw"] == CSV[1]
    metrics = {r["metric"]: r["value"] for r in st.metrics_frame(spark, f"{base}/audit").collect()}
    assert metrics["ingestion.unparsed_records"] == 6
    # an incremental run takes the failed records past the mark only, and those without one
    lines(spark, f"{base}/in", ["9,2024-02-01 00:00:00,9,later", "10,2024-02-02 00:00:00,dear,later and broken"])
    again = run(spark, spec(base))
    assert again.row_count == 1
    later = spark.read.parquet(f"{base}/dlq/ds_unparsed").filter("_dlq_raw LIKE '%later%'")
    assert later.count() == 1 and later.first()["id"] == 10


def test_clean_source_reports_nothing(spark, base):
    lines(spark, f"{base}/in", CSV[:1])
    assert run(spark, spec(base)).quarantine_path is None


def test_fail_stops_the_run(spark, base):
    lines(spark, f"{base}/in", CSV)
    s = spec(base)
    s.source.on_parse_error = "fail"
    with pytest.raises(Exception, match="(?i)malformed"):
        run(spark, s)
    assert not fs.exists(spark, f"{base}/out")


def test_stream(spark, base):
    lines(spark, f"{base}/in", CSV)
    run_available_now(spark, spec(base), checkpoint=f"{base}/ckpt")
    lines(spark, f"{base}/in", ["11,2024-03-01 00:00:00,1,fine", "12,never,1,no"])
    run_available_now(spark, spec(base), checkpoint=f"{base}/ckpt")
    assert {r["id"] for r in spark.read.parquet(f"{base}/out").collect()} == {1, 6, 7, 11}
    assert spark.read.parquet(f"{base}/dlq/ds_unparsed").count() == 6


@pytest.mark.parametrize("over", [{"quarantine": None}, {"source": {"type": "parquet", "options": {}, "on_parse_error": "quarantine"}},
                                  {"source": {"type": "csv", "options": {}, "on_parse_error": "ignore"}}])
def test_refused_specs(base, over):
    with pytest.raises(SpecError):
        spec(base, **over)
