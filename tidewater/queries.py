"""Registered queries: each runs one operator of the library end to end on the given
tables (whole tables; every intermediate output goes to the shared scratch root) and
returns a DataFrame whose columns match the DuckDB statement in ``ORACLE``.

Scenario splits use the data's own dates: ``CUT`` separates "earlier" from "later"
orders, and ``REVISED_FROM`` starts a re-delivered, corrected slice that overlaps it.
Nulls, which the driver tables do not have, are injected into ``o_custkey`` for the
urgent orders by a custom transform.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fs
from .errors import DataQualityError
from .functions import typed
from .operators import (add_metadata, apply_chain, cast_columns, check_quality, compile_chain,
                        dedup_any, dedup_latest, drop_columns, rename_columns, result_frame)
from .operators.quality import WM_MAX, run_profile
from .plans import run, run_many
from .plans import state as st
from .session import scratch_path, unique_name
from .sinks import (BATCH_ID, WriteContext, compact_marks, read_file_target, register_target, repair_partitions,
                    write_target)
from .sinks.logfmt import append_logfmt, overwrite_logfmt
from .sources import decode_json_value, read_incremental, read_source, register_source
from .sources.logfmt import read_logfmt
from .sources.parsing import RAW, UNPARSED
from .spec import FieldSpec, QualitySpec, SourceSpec, TargetSpec, TransformSpec, spec_from_dict

# Scenario constants shared by the Spark queries and their oracles.
CUT = "1998-01-01 00:00:00"
REVISED_FROM = "1997-01-01 00:00:00"
URGENT = "1-URGENT"
HIGH = "2-HIGH"
ORDERS_DDL = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string")
EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
ORDERS_FIELDS = [FieldSpec(*f.split(" ")) for f in ORDERS_DDL.split(", ")]
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

Query = Callable[[SparkSession, str], DataFrame]


# --------------------------------------------------------------------------- helpers

def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _earlier(df: DataFrame) -> DataFrame:
    return df.filter(F.col("o_orderdate") <= _ts(CUT))


def _later(df: DataFrame) -> DataFrame:
    return df.filter(F.col("o_orderdate") > _ts(CUT))


def _revised(df: DataFrame) -> DataFrame:
    """The corrected re-delivery: orders since REVISED_FROM at double price."""
    return (df.filter(F.col("o_orderdate") >= _ts(REVISED_FROM))
            .withColumn("o_totalprice", F.col("o_totalprice") * 2))


def _inject_nulls(df: DataFrame) -> DataFrame:
    return df.withColumn("o_custkey", F.when(F.col("o_orderpriority") != URGENT, F.col("o_custkey")))


def _parquet_source(path: str, **kw) -> dict:
    return {"type": "parquet", "options": {"path": path}, **kw}


def _land(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def _orders_schema() -> list[dict]:
    return [{"name": c.split()[0], "type": c.split()[1]} for c in ORDERS_DDL.split(", ")]


# --------------------------------------------------------------------------- sources

def scan_parquet(spark, d):
    return read_source(spark, SourceSpec("parquet", {"path": f"{d}/orders.parquet"}))


def scan_csv(spark, d):
    path = scratch_path(spark, "scan_csv")
    _table(spark, d, "orders").write.option("header", "true").csv(path)
    src = SourceSpec("csv", {"path": path}, schema=[FieldSpec(**f) for f in _orders_schema()])
    return read_source(spark, src)


def scan_json(spark, d):
    path = scratch_path(spark, "scan_json")
    _table(spark, d, "orders").write.json(path)
    src = SourceSpec("json", {"path": path}, schema=[FieldSpec(**f) for f in _orders_schema()])
    return read_source(spark, src)


LINEITEM_DDL = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz")
DOCUMENTS_DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EMBEDDINGS_DDL = "vec_id bigint, embedding array<float>, label int"


def _fields(ddl: str) -> list[FieldSpec]:
    return [FieldSpec(name, type_) for name, type_ in (c.split(" ", 1) for c in ddl.split(", "))]


def scan_csv_documents(spark, d):
    """Whole multi-line texts with quotes through CSV: quoted fields, multiLine reader."""
    path = scratch_path(spark, "scan_csv_documents")
    _table(spark, d, "documents").write.option("header", "true").csv(path)
    src = SourceSpec("csv", {"path": path, "multiLine": "true"}, schema=_fields(DOCUMENTS_DDL))
    return read_source(spark, src)


def scan_json_embeddings(spark, d):
    """Nested values (float arrays) through JSON lines with a declared schema."""
    path = scratch_path(spark, "scan_json_embeddings")
    _table(spark, d, "embeddings").write.json(path)
    return read_source(spark, SourceSpec("json", {"path": path}, schema=_fields(EMBEDDINGS_DDL)))


def _orders_table(spark, d, name: str, partition_by: list[str] | None = None, table_name: str = "orders") -> str:
    table = unique_name(name)
    writer = _table(spark, d, table_name).write.option("path", scratch_path(spark, name))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return table


def scan_table(spark, d):
    table = _orders_table(spark, d, "scan_table")
    return read_source(spark, SourceSpec("hive", {"table": table}))


def scan_table_partition_filter(spark, d):
    table = _orders_table(spark, d, "scan_tpf", ["c_mktsegment"], "customer")
    return read_source(spark, SourceSpec("table", {"table": table, "partition_filter": "c_mktsegment = 'BUILDING'"}))


def initial_scan(spark, d):
    state = scratch_path(spark, "initial_scan_state")
    marks = st.read_state(spark, state, "orders", ["file"])  # nothing stored yet
    src = SourceSpec("parquet", {"path": f"{d}/orders.parquet"}, watermark_column="o_orderdate")
    return read_incremental(spark, src, marks["file"].watermark if "file" in marks else None)


def _state_with_cut(spark) -> str:
    state = scratch_path(spark, "state")
    st.commit_state(spark, state, "orders", [st.StateEntry("file", "o_orderdate", "timestamp_ntz", CUT, 1)])
    return state


def incremental_scan(spark, d):
    marks = st.read_state(spark, _state_with_cut(spark), "orders", ["file"])
    src = SourceSpec("parquet", {"path": f"{d}/orders.parquet"}, watermark_column="o_orderdate")
    return read_incremental(spark, src, marks["file"].watermark)


def next_watermark(spark, d):
    marks = st.read_state(spark, _state_with_cut(spark), "orders", ["file"])
    src = SourceSpec("parquet", {"path": f"{d}/orders.parquet"}, watermark_column="o_orderdate")
    batch = read_incremental(spark, src, marks["file"].watermark)
    value = run_profile(batch, QualitySpec(), "o_orderdate")[WM_MAX]
    return spark.range(1).select(typed.parse(value, "timestamp_ntz").alias("watermark"))


def scan_custom_source(spark, d):
    """A user-defined source over a partitioned folder in a format of the user's own."""
    path = _write_logfmt(spark, d, "scan_custom")
    register_source("logfmt", read_logfmt)
    return read_source(spark, SourceSpec("logfmt", {"path": path}, schema=ORDERS_FIELDS))


def _write_logfmt(spark, d, name: str, mode: str = "append", path: str | None = None) -> str:
    register_target("logfmt", append=append_logfmt, overwrite=overwrite_logfmt)
    path = path or scratch_path(spark, name)
    write_target(spark, _table(spark, d, "orders"),
                 TargetSpec("logfmt", {"path": path}, write_mode=mode, partition_columns=["o_orderstatus"]))
    return path


def decode_json_value_q(spark, d):
    return decode_json_value(_table(spark, d, "events"), "k bigint", value_col="props", keep=["event_id"])


def decode_json_value_flagged(spark, d):
    """Decode keeping an envelope column and flagging payloads that do not decode."""
    return decode_json_value(_table(spark, d, "events"), "k bigint", value_col="props",
                             keep=["event_id", "ts"], flag_column="_undecodable")


def incremental_overlap_scan(spark, d):
    """``watermark_overlap``: rows at the stored mark are read again (for merge targets)."""
    marks = st.read_state(spark, _state_with_cut(spark), "orders", ["file"])
    src = SourceSpec("parquet", {"path": f"{d}/orders.parquet"}, watermark_column="o_orderdate",
                     watermark_overlap=True)
    return read_incremental(spark, src, marks["file"].watermark)


# --------------------------------------------------------------------------- transforms

def rename_columns_q(spark, d):
    return rename_columns(_table(spark, d, "orders"), {"o_orderkey": "o_custkey", "o_custkey": "o_orderkey",
                                                       "not_there": "x"})


def cast_columns_q(spark, d):
    df = _table(spark, d, "orders").select(
        "o_orderkey", F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("prio"),
        F.col("o_orderstatus").alias("bad"))
    return cast_columns(df, {"prio": "int", "bad": "int"})


def add_metadata_q(spark, d):
    out = add_metadata(_table(spark, d, "orders"), "orders")
    return out.select("o_orderkey", "_dataset_name", F.col("_ingested_at").isNotNull().alias("has_ingested_at"))


def drop_columns_q(spark, d):
    return drop_columns(_table(spark, d, "orders"), ["o_orderpriority", "zz"])


TRANSFORM_CHAIN = [
    {"type": "rename", "mapping": {"o_custkey": "customer_id", "o_totalprice": "amount"}},
    {"type": "cast", "columns": {"amount": "decimal(18,2)"}},
    {"type": "deduplicate", "keys": ["customer_id"], "order_by": ["o_orderdate"], "tie_breakers": ["o_orderkey"]},
    {"type": "drop", "columns": ["o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]},
]


def transform_chain(spark, d):
    import datetime as _dt

    specs = [TransformSpec(t["type"], {k: v for k, v in t.items() if k != "type"}) for t in TRANSFORM_CHAIN]
    fns = compile_chain(specs, "orders", _dt.datetime.now(_dt.timezone.utc))
    return apply_chain(_table(spark, d, "orders"), fns)


def dedup_any_q(spark, d):
    return dedup_any(_table(spark, d, "orders"), ["o_custkey"]).select("o_custkey")


def dedup_latest_q(spark, d):
    return dedup_latest(_table(spark, d, "orders"), ["o_custkey"], "o_orderdate", "o_orderkey", method="window")


def dedup_latest_agg(spark, d):
    return dedup_latest(_table(spark, d, "orders"), ["o_custkey"], "o_orderdate", "o_orderkey", method="agg")


# --------------------------------------------------------------------------- quality

def _quality(spark, d, spec: QualitySpec, expected=None, nulls: bool = False) -> DataFrame:
    df = _table(spark, d, "orders")
    if nulls:
        df = _inject_nulls(df)
    return result_frame(spark, "orders", check_quality(df, spec, expected))


def dq_min_row_count(spark, d):
    return _quality(spark, d, QualitySpec(min_row_count=1_000_000)).filter("check_name = 'min_row_count'")


def dq_null_fraction(spark, d):
    spec = QualitySpec(max_null_fraction={"o_custkey": 0.1})
    return _quality(spark, d, spec, nulls=True).filter("check_name = 'max_null_fraction'")


def dq_expected_columns(spark, d):
    expected = [FieldSpec("o_orderkey", "bigint"), FieldSpec("o_custkey", "int"), FieldSpec("zz", "string")]
    spec = QualitySpec(schema_level="type")
    return _quality(spark, d, spec, expected).filter("check_name = 'schema_validation'")


def dq_suite(spark, d):
    spec = QualitySpec(min_row_count=1, max_null_fraction={"o_custkey": 0.1})
    res = _quality(spark, d, spec, [FieldSpec("o_orderkey", "bigint"), FieldSpec("zz", "string")], nulls=True)
    return res.groupBy("check_name").agg(F.bool_and("passed").alias("passed"))


def _gate_spec(base: str, src: str, **extra) -> dict:
    raw = {
        "dataset_name": "orders",
        "source": _parquet_source(src),
        "data_quality": {"max_null_fraction": {"o_custkey": 0.1}, "fail_pipeline_on_violation": False},
        "targets": [{"type": "file", "options": {"path": f"{base}/target"}}],
        "state_path": f"{base}/state", "audit_path": f"{base}/audit",
    }
    raw.update(extra)
    return raw


def dq_gate_continue(spark, d):
    base = scratch_path(spark, "dq_gate_continue")
    res = run(spark, spec_from_dict(_gate_spec(base, f"{d}/orders.parquet")), transforms=[_inject_nulls])
    assert not res.quality.passed
    return spark.read.parquet(f"{base}/target").select("o_orderkey", "o_custkey")


def quarantine_batch_q(spark, d):
    base = scratch_path(spark, "quarantine_batch")
    raw = _gate_spec(base, f"{d}/orders.parquet", quarantine={"path": f"{base}/dlq", "mode": "batch"})
    raw["data_quality"]["fail_pipeline_on_violation"] = True
    try:
        run(spark, spec_from_dict(raw), transforms=[_inject_nulls])
    except DataQualityError:
        pass
    return spark.read.parquet(f"{base}/dlq/orders").select("o_orderkey", "o_custkey", "_dlq_reason")


def quarantine_rows_q(spark, d):
    base = scratch_path(spark, "quarantine_rows")
    raw = _gate_spec(base, f"{d}/orders.parquet", quarantine={
        "path": f"{base}/dlq", "mode": "rows", "not_null": ["o_custkey"],
        "rules": {"non-positive price": "o_totalprice > 0"}})
    run(spark, spec_from_dict(raw), transforms=[_inject_nulls])
    good = spark.read.parquet(f"{base}/target").select("o_orderkey", F.lit("").alias("_dlq_reason"))
    bad = spark.read.parquet(f"{base}/dlq/orders").select("o_orderkey", "_dlq_reason")
    return good.unionByName(bad)


def _misfits(orders: DataFrame) -> DataFrame:
    """Orders as text, with a customer key or a price that is no number for two priorities."""
    return orders.select(*[F.col(c).cast("string").alias(c) for c in ORDER_COLS]).withColumns({
        "o_custkey": F.when(F.col("o_orderpriority") == URGENT, F.concat(F.lit("c-"), "o_custkey")).otherwise(F.col("o_custkey")),
        "o_totalprice": F.when(F.col("o_orderpriority") == HIGH, F.lit("n/a")).otherwise(F.col("o_totalprice"))})


def _misfit_messages(orders: DataFrame) -> DataFrame:
    """The same as JSON payloads, whose numbers are numbers otherwise."""
    value = F.to_json(F.struct(*ORDER_COLS))
    for priority, pattern, text in ((URGENT, r'"o_custkey":([0-9]+)', '"o_custkey":"c-$1"'),
                                    (HIGH, r'"o_totalprice":[0-9.E]+', '"o_totalprice":"n/a"')):
        value = F.when(F.col("o_orderpriority") == priority, F.regexp_replace(value, pattern, text)).otherwise(value)
    return orders.select(value.alias("value"))


def quarantine_unparsed(spark, d):
    """Records with a field that does not parse leave a CSV and a JSON load with that field's name
    and their raw text; the others arrive."""
    base = scratch_path(spark, "quarantine_unparsed")
    orders = _table(spark, d, "orders")
    _misfits(orders).write.option("header", "true").csv(f"{base}/csv/landing")
    _misfit_messages(orders).write.text(f"{base}/json/landing")
    out = []
    for kind in ("csv", "json"):
        spec = spec_from_dict({
            "dataset_name": "orders", "source": {"type": kind, "options": {"path": f"{base}/{kind}/landing"},
                                                 "schema": _orders_schema(), "on_parse_error": "quarantine"},
            "targets": [{"type": "file", "options": {"path": f"{base}/{kind}/target"}, "write_mode": "append"}],
            "quarantine": {"path": f"{base}/{kind}/dlq"}, "state_path": f"{base}/{kind}/state",
            "audit_path": f"{base}/{kind}/audit"})
        run(spark, spec)
        good = spark.read.schema(ORDERS_DDL).parquet(f"{base}/{kind}/target").select(
            "o_orderkey", "o_custkey", "o_totalprice", F.lit("").alias("failed"), F.lit(False).alias("raw_kept"))
        bad = spark.read.parquet(f"{base}/{kind}/dlq/orders_unparsed").select(
            "o_orderkey", "o_custkey", "o_totalprice", F.array_join("_dlq_fields", ",").alias("failed"),
            F.col("_dlq_raw").contains(F.col("o_orderkey").cast("string")).alias("raw_kept"))
        out.append(good.unionByName(bad).withColumn("kind", F.lit(kind)))
    return out[0].unionByName(out[1])


def decode_json_value_failures(spark, d):
    """Message payloads with one field of several that does not fit: named, flagged, text kept."""
    out = decode_json_value(_misfit_messages(_table(spark, d, "orders")), ORDERS_DDL, flag_column="undecodable",
                            failures=True)
    return out.select("o_orderkey", "o_custkey", "o_totalprice", "undecodable", F.array_join(UNPARSED, ",").alias("failed"),
                      F.col(RAW).isNotNull().alias("raw_kept"))


def run_metrics(spark, d):
    base = scratch_path(spark, "run_metrics")
    res = run(spark, spec_from_dict(_gate_spec(base, f"{d}/orders.parquet")), transforms=[_inject_nulls])
    return (st.metrics_frame(spark, f"{base}/audit").filter(F.col("run_id") == res.run_id)
            .select("metric", "value"))


# --------------------------------------------------------------------------- state

def state_lookup(spark, d):
    state = scratch_path(spark, "state_lookup")
    orders = _table(spark, d, "orders")
    slices = [orders.filter(F.col("o_orderdate") < _ts(REVISED_FROM)), _earlier(orders), orders]
    for i, part in enumerate(slices, start=1):
        value = run_profile(part, QualitySpec(), "o_orderdate")[WM_MAX]
        st.commit_state(spark, state, "orders", [st.StateEntry("file", "o_orderdate", "timestamp_ntz", value, i)])
    return (st.latest_state(spark, state, "orders")
            .select("dataset", "target", F.expr("cast(value as timestamp_ntz)").alias("watermark")))


def _incremental_spec(base: str, landing: str, **target) -> dict:
    return {
        "dataset_name": "orders",
        "source": _parquet_source(landing, watermark_column="o_orderdate"),
        "targets": [{"type": "file", "options": {"path": f"{base}/target"}, **target}],
        "state_path": f"{base}/state", "audit_path": f"{base}/audit",
    }


def state_advance(spark, d):
    base = scratch_path(spark, "state_advance")
    landing = _land(_earlier(_table(spark, d, "orders")), f"{base}/landing")
    spec = spec_from_dict(_incremental_spec(base, landing))
    run(spark, spec)
    second = run(spark, spec)  # nothing new: empty batch, state left alone
    assert second.row_count == 0
    return (st.latest_state(spark, f"{base}/state", "orders")
            .select(F.expr("cast(value as timestamp_ntz)").alias("watermark")))


def incremental_two_runs(spark, d):
    base = scratch_path(spark, "incremental_two_runs")
    orders = _table(spark, d, "orders")
    landing = _land(_earlier(orders), f"{base}/landing")
    spec = spec_from_dict(_incremental_spec(base, landing, write_mode="merge", merge_keys=["o_orderkey"]))
    run(spark, spec)
    _land(orders.withColumn("o_totalprice", F.col("o_totalprice") * 2), landing)
    run(spark, spec)
    return spark.read.parquet(f"{base}/target").select("o_orderkey", "o_orderdate", "o_totalprice")


# --------------------------------------------------------------------------- sinks

def _file_target(path: str, **kw) -> TargetSpec:
    return TargetSpec("file", {"path": path, **kw.pop("options", {})}, **kw)


def sink_file_append(spark, d):
    path = scratch_path(spark, "sink_file_append")
    orders = _table(spark, d, "orders")
    t = _file_target(path)
    write_target(spark, _earlier(orders), t)
    write_target(spark, _later(orders), t)
    return spark.read.schema(ORDERS_DDL).parquet(path)


def sink_file_overwrite(spark, d):
    path = scratch_path(spark, "sink_file_overwrite")
    orders = _table(spark, d, "orders")
    t = _file_target(path, write_mode="overwrite")
    write_target(spark, _earlier(orders), t)
    write_target(spark, orders, t)
    return spark.read.schema(ORDERS_DDL).parquet(path)


def sink_partitioned(spark, d):
    path = scratch_path(spark, "sink_partitioned")
    write_target(spark, _table(spark, d, "events"), _file_target(path, partition_columns=["event_type"]))
    assert len(fs.list_dirs(spark, path)) == _table(spark, d, "events").select("event_type").distinct().count()
    return spark.read.schema(EVENTS_DDL).parquet(path)


def sink_manifest(spark, d):
    path = scratch_path(spark, "sink_manifest")
    manifest = f"{path}_manifest"
    orders = _table(spark, d, "orders")
    write_target(spark, orders, _file_target(path, options={"manifest_path": manifest}))
    from .functions import content_hash

    written = spark.read.schema(ORDERS_DDL).parquet(path)
    recomputed = written.agg(content_hash(written.columns).cast("string")).first()[0]
    return (spark.read.json(manifest)
            .select(F.col("row_count"), (F.col("checksum") == F.lit(recomputed)).alias("checksum_verified")))


def _table_target(spark, name: str, **kw) -> TargetSpec:
    opts = {"table": unique_name(name), "path": scratch_path(spark, name)}
    opts.update(kw.pop("options", {}))
    return TargetSpec("table", opts, **kw)


def sink_table_append(spark, d):
    orders = _table(spark, d, "orders")
    t = _table_target(spark, "sink_table_append")
    write_target(spark, _earlier(orders), t)
    write_target(spark, _later(orders).select(*reversed(ORDER_COLS)), t)  # columns match by name
    return spark.table(t.options["table"])


def sink_table_overwrite(spark, d):
    orders = _table(spark, d, "orders")
    t = _table_target(spark, "sink_table_overwrite", write_mode="overwrite")
    write_target(spark, _earlier(orders), t)
    write_target(spark, orders, t)
    return spark.table(t.options["table"])


def table_repair_partitions(spark, d):
    events = _table(spark, d, "events")
    t = _table_target(spark, "table_repair", partition_columns=["event_type"])
    first_types = ["click", "view"]
    write_target(spark, events.filter(F.col("event_type").isin(first_types)), t)
    # other partitions land in the table's folder without going through the catalog
    (events.filter(~F.col("event_type").isin(first_types)).write.mode("append")
     .partitionBy("event_type").parquet(t.options["path"]))
    repair_partitions(spark, t.options["table"])
    return spark.table(t.options["table"])


def append_evolving_schema(spark, d):
    path = scratch_path(spark, "append_evolving")
    orders = _table(spark, d, "orders")
    t = _file_target(path)
    write_target(spark, _earlier(orders).select("o_orderkey", "o_orderdate"), t)
    write_target(spark, _later(orders).select("o_orderkey", "o_orderdate", "o_orderstatus"), t)
    return spark.read.option("mergeSchema", "true").parquet(path).select("o_orderkey", "o_orderstatus")


def table_append_evolving_schema(spark, d):
    """Catalog table: the second append brings a new column, added to the table first."""
    orders = _table(spark, d, "orders")
    t = _table_target(spark, "table_append_evolving")
    write_target(spark, _earlier(orders).select("o_orderkey", "o_orderdate"), t)
    write_target(spark, _later(orders).select("o_orderkey", "o_orderdate", "o_orderstatus"), t)
    return spark.table(t.options["table"]).select("o_orderkey", "o_orderstatus")


def overwrite_evolving_schema(spark, d):
    path = scratch_path(spark, "overwrite_evolving")
    orders = _table(spark, d, "orders")
    t = _file_target(path, write_mode="overwrite")
    write_target(spark, orders.select("o_orderkey", "o_totalprice"), t)
    write_target(spark, orders.select("o_orderkey", "o_orderstatus"), t)
    return spark.read.parquet(path)


def _two_target_spec(spark, base: str, d: str) -> dict:
    return {
        "dataset_name": "orders",
        "source": _parquet_source(f"{d}/orders.parquet"),
        "targets": [
            {"type": "s3", "options": {"path": f"{base}/file"}},
            {"type": "hive", "options": {"table": unique_name("fan_out"), "path": f"{base}/table"}},
        ],
        "state_path": f"{base}/state", "audit_path": f"{base}/audit",
    }


def _labelled_targets(spark, spec) -> DataFrame:
    file_rows = spark.read.schema(ORDERS_DDL).parquet(spec.target("file").options["path"])
    table_rows = spark.table(spec.target("table").options["table"]).select(*ORDER_COLS)
    return (file_rows.select(F.lit("file").alias("target"), *ORDER_COLS)
            .unionByName(table_rows.select(F.lit("table").alias("target"), *ORDER_COLS)))


def fan_out(spark, d):
    base = scratch_path(spark, "fan_out")
    spec = spec_from_dict(_two_target_spec(spark, base, d))
    res = run(spark, spec)
    assert res.targets_written == ["file", "table"]
    return _labelled_targets(spark, spec)


def sink_custom_target(spark, d):
    """A user-defined target: written, then overwritten, and read back whole."""
    path = _write_logfmt(spark, d, "sink_custom")
    _write_logfmt(spark, d, "sink_custom", "overwrite", path)
    return read_logfmt(spark, SourceSpec("logfmt", {"path": path}, schema=ORDERS_FIELDS))


def append_idempotent_moved_partition(spark, d):
    """A replayed batch whose rows now lie in other partitions replaces the whole batch."""
    path = scratch_path(spark, "append_moved")
    orders = _table(spark, d, "orders")
    t = _file_target(path, idempotent=True, partition_columns=["load_day"])
    for day in ("a", "b"):
        write_target(spark, orders.withColumn("load_day", F.lit(day)), t, WriteContext(batch_id=1))
    return spark.read.schema(f"{ORDERS_DDL}, {BATCH_ID} int, load_day string").parquet(path).select("o_orderkey", "load_day")


def upsert_two_level_partitions(spark, d):
    """Partitions by day and status: thousands of touched combinations."""
    path = scratch_path(spark, "upsert_two_level")
    orders = _table(spark, d, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM"))
    t = _file_target(path, write_mode="merge", merge_keys=["o_orderkey", "day", "o_orderstatus"],
                     partition_columns=["day", "o_orderstatus"])
    write_target(spark, _earlier(orders), t, WriteContext())
    write_target(spark, _revised(orders), t, WriteContext())
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice")


def upsert_insert_only_fewer_columns(spark, d):
    """New keys without one of the target's columns: the column stays, null for them."""
    path = scratch_path(spark, "upsert_fewer")
    orders = _table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    t = _file_target(path, write_mode="merge", merge_keys=["o_orderkey"])
    write_target(spark, _earlier(orders), t, WriteContext())
    write_target(spark, _later(orders).drop("o_totalprice"), t, WriteContext())
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice")


def rename_columns_case(spark, d):
    """Names are found as the session compares them."""
    return rename_columns(_table(spark, d, "orders").select("o_orderkey", "o_custkey"), {"O_ORDERKEY": "k", "O_CustKey": "c"})


def dedup_latest_case(spark, d):
    out = dedup_latest(_table(spark, d, "orders"), ["O_CUSTKEY"], "O_OrderDate", "O_ORDERKEY")
    return out.select("o_custkey", "o_orderkey")


def _shared_spec(spark, d, base, name, **over):
    _land(_table(spark, d, "orders"), f"{base}/landing", "ignore")
    return spec_from_dict({
        "dataset_name": name, "source": {"type": "parquet", "options": {"path": f"{base}/landing"}, "watermark_column": "o_orderkey"},
        "targets": [{"type": "file", "options": {"path": f"{base}/{name}"}, "write_mode": "append"}],
        "state_path": f"{base}/state", "audit_path": f"{base}/audit", **over})


def incremental_compound_mark(spark, d):
    """The first load ends in the middle of a day; the day's later orders have the same mark and are
    read by the second, once."""
    base = scratch_path(spark, "compound")
    orders = _table(spark, d, "orders")
    day = _earlier(orders).agg(F.max("o_orderdate").alias("day"))
    middle = (orders.join(F.broadcast(day), orders["o_orderdate"] == day["day"])
              .agg(F.first("day"), F.percentile_approx("o_orderkey", 0.5)).first())
    spec = _shared_spec(spark, d, base, "compound", source={
        "type": "parquet", "options": {"path": f"{base}/landing"}, "watermark_column": "o_orderdate",
        "watermark_tie_column": "o_orderkey"})
    seen = (F.col("o_orderdate") < F.lit(middle[0])) | ((F.col("o_orderdate") == F.lit(middle[0])) & (F.col("o_orderkey") <= middle[1]))
    for part in (orders.filter(seen), orders):
        _land(part, f"{base}/landing")
        run(spark, spec)
    return spark.read.schema(ORDERS_DDL).parquet(f"{base}/compound")


def incremental_late_rows(spark, d):
    """Orders dated before the mark that arrive after it, in files of their own, are loaded too."""
    base = scratch_path(spark, "late_rows")
    orders = _table(spark, d, "orders")
    late = F.col("o_orderpriority") == URGENT
    spec = _shared_spec(spark, d, base, "late", source={
        "type": "parquet", "options": {"path": f"{base}/landing"}, "watermark_column": "o_orderdate",
        "late_rows": "new_files", "late_margin_seconds": 0},
        targets=[{"type": "file", "options": {"path": f"{base}/late"}, "write_mode": "merge", "merge_keys": ["o_orderkey"]}])
    _land(_earlier(orders).filter(~late), f"{base}/landing")
    run(spark, spec)
    _land(_earlier(orders).filter(late), f"{base}/landing", "append")
    _land(_later(orders), f"{base}/landing", "append")
    second = run(spark, spec)
    assert second.row_count == orders.count() - _earlier(orders).filter(~late).count()
    return spark.read.schema(ORDERS_DDL).parquet(f"{base}/late")


def run_many_shared_state(spark, d):
    """Datasets side by side on one state folder: each has its mark and its audit row."""
    base = scratch_path(spark, "run_many_shared")
    specs = [_shared_spec(spark, d, base, f"ds{i:02d}") for i in range(12)]
    for r in run_many(spark, specs, parallelism=4):
        if isinstance(r, BaseException):
            raise r
    marks = st.state_frame(spark, f"{base}/state").select("dataset", F.col("value").cast("bigint").alias("mark"))
    audits = st.audit_frame(spark, f"{base}/audit").groupBy("dataset").agg(F.count(F.lit(1)).alias("audits"))
    return marks.join(audits, "dataset")


def incremental_diverging_marks(spark, d):
    """Two targets with different marks and a dedup: each ends up as if it had run alone."""
    base = scratch_path(spark, "diverging")
    orders = _table(spark, d, "orders")
    targets = [{"type": "file", "name": t, "options": {"path": f"{base}/{t}"}, "write_mode": "merge", "merge_keys": ["o_custkey"]}
               for t in ("one", "two")]
    spec = _shared_spec(spark, d, base, "diverging", targets=targets, transforms=[
        {"type": "deduplicate", "keys": ["o_custkey"], "order_by": "o_totalprice", "tie_breakers": ["o_orderkey"]}])
    thirds = orders.approxQuantile("o_orderkey", [1 / 3, 2 / 3], 0.0)
    for cut, only in ((thirds[0], None), (thirds[1], ["one"]), (float("inf"), None)):
        _land(orders.filter(F.col("o_orderkey") <= cut), f"{base}/landing")
        run(spark, spec, targets=only)
    return (spark.read.parquet(f"{base}/two").select("o_custkey", "o_orderkey", F.lit("two").alias("target"))
            .union(spark.read.parquet(f"{base}/one").select("o_custkey", "o_orderkey", F.lit("one").alias("target"))))


def append_idempotent(spark, d):
    path = scratch_path(spark, "append_idempotent")
    orders = _table(spark, d, "orders")
    t = _file_target(path, idempotent=True)
    write_target(spark, _earlier(orders), t, WriteContext(batch_id=1))
    write_target(spark, _later(orders), t, WriteContext(batch_id=2))
    write_target(spark, _later(orders), t, WriteContext(batch_id=2))  # replay after a lost commit
    return spark.read.schema(f"{ORDERS_DDL}, {BATCH_ID} int").parquet(path).select("o_orderkey", BATCH_ID)


# --------------------------------------------------------------------------- upserts

def upsert_file(spark, d):
    path = scratch_path(spark, "upsert_file")
    orders = _table(spark, d, "orders")
    t = _file_target(path, write_mode="merge", merge_keys=["o_orderkey"])
    write_target(spark, _earlier(orders), t)
    write_target(spark, _revised(orders), t)
    return spark.read.schema(ORDERS_DDL).parquet(path)


def upsert_file_partitioned(spark, d):
    """Partition columns inside the merge key: only the touched partitions are rewritten."""
    path = scratch_path(spark, "upsert_file_part")
    orders = _table(spark, d, "orders")
    t = _file_target(path, write_mode="merge", merge_keys=["o_orderkey", "o_orderstatus"],
                     partition_columns=["o_orderstatus"])
    write_target(spark, orders, t)
    report = write_target(spark, _revised(orders).filter(F.col("o_orderstatus") == "O"), t)
    assert report.extra.get("scope") == "dynamic"
    return spark.read.schema(ORDERS_DDL).parquet(path)


def upsert_file_moving_partitions(spark, d):
    """Partitioned by priority, keyed by order: re-prioritized orders leave their partition;
    only the partitions holding a matched key or receiving a batch row are rewritten."""
    path = scratch_path(spark, "upsert_file_move")
    orders = _table(spark, d, "orders")
    t = _file_target(path, write_mode="merge", merge_keys=["o_orderkey"], partition_columns=["o_orderpriority"])
    write_target(spark, orders, t)
    moved = (_revised(orders).filter(F.col("o_orderpriority") == URGENT)
             .withColumn("o_orderpriority", F.lit(HIGH)))
    report = write_target(spark, moved, t)
    assert report.extra.get("scope") == "dynamic" and report.extra.get("replaced") == 2
    return spark.read.schema(ORDERS_DDL).parquet(path)


def _in_date_files(orders: DataFrame, t: TargetSpec) -> None:
    """Land orders as files of consecutive dates."""
    orders.repartitionByRange(16, "o_orderdate").write.parquet(t.options["path"])


def upsert_touched_files(spark, d):
    """Only the files that hold a revised order are rewritten."""
    orders = _table(spark, d, "orders")
    t = _file_target(scratch_path(spark, "upsert_files"), write_mode="merge", merge_keys=["o_orderkey"])
    t.options["rewrite"] = "files"
    _in_date_files(_earlier(orders), t)
    report = write_target(spark, _revised(orders), t)
    assert report.extra["scope"] == "files" and report.extra["replaced"] < 8
    return spark.read.schema(ORDERS_DDL).parquet(t.options["path"])


def _marked(spark, d):
    orders = _table(spark, d, "orders")
    t = _file_target(scratch_path(spark, "upsert_marks"), write_mode="merge", merge_keys=["o_orderkey"])
    t.options["rewrite"] = "marks"
    _in_date_files(_earlier(orders), t)
    urgent = F.col("o_orderpriority") == URGENT
    write_target(spark, orders.filter(urgent).withColumn("o_totalprice", F.lit(0.0)), t)  # overwritten next
    report = write_target(spark, _revised(orders), t)
    assert report.extra["scope"] == "marks" and report.extra["marked"] > 0
    return t


def upsert_marks(spark, d):
    """Merge on read: matched rows are marked by position, the batches are added as files."""
    return read_file_target(spark, _marked(spark, d))


def upsert_marks_compacted(spark, d):
    """The same after the files with marks were rewritten: any reader sees the result."""
    t = _marked(spark, d)
    compact_marks(spark, t)
    return spark.read.schema(ORDERS_DDL).parquet(t.options["path"])


def upsert_out_of_order(spark, d):
    """Versions of an order arrive in the wrong order, twice, and with the same key in one batch:
    the newest by version stays, in file and table targets."""
    orders = _table(spark, d, "orders")
    versions = {k: orders.withColumn("o_totalprice", F.col("o_totalprice") * k).withColumn("version", F.lit(k))
                for k in (1, 2, 3)}
    batches = [versions[2].filter(_ts(REVISED_FROM) <= F.col("o_orderdate")), versions[1].unionByName(
        versions[3].filter(F.col("o_orderpriority") == URGENT)), versions[2].filter(F.col("o_orderstatus") == "F")]
    outs = []
    for name, t in (("files", _file_target(scratch_path(spark, "versioned"), write_mode="merge", merge_keys=["o_orderkey"])),
                    ("table", _table_target(spark, "versioned", write_mode="merge", merge_keys=["o_orderkey"]))):
        t.options |= {"version_column": "version", **({"rewrite": "files"} if name == "files" else {})}
        for batch in [*batches, batches[0]]:
            write_target(spark, batch, t)
        rows = spark.read.parquet(t.options["path"]) if name == "files" else spark.table(t.options["table"])
        outs.append(rows.select("o_orderkey", "o_totalprice", "version", F.lit(name).alias("target")))
    return outs[0].unionByName(outs[1])


def upsert_table(spark, d):
    orders = _table(spark, d, "orders")
    t = _table_target(spark, "upsert_table", write_mode="upsert", merge_keys=["o_orderkey"])
    write_target(spark, _earlier(orders), t)
    write_target(spark, _revised(orders), t)
    return spark.table(t.options["table"])


def stream_available_now_upsert(spark, d):
    from .streaming import run_available_now

    base = scratch_path(spark, "stream_upsert")
    orders = _table(spark, d, "orders")
    landing = f"{base}/landing"
    spec = spec_from_dict({
        "dataset_name": "orders",
        "source": {"type": "parquet", "options": {"path": landing}, "schema": _orders_schema()},
        "targets": [{"type": "file", "options": {"path": f"{base}/target"},
                     "write_mode": "merge", "merge_keys": ["o_orderkey"]}],
        "audit_path": f"{base}/audit",
    })
    ckpt = f"{base}/checkpoint"
    _land(_earlier(orders), landing, "append")
    run_available_now(spark, spec, checkpoint=ckpt)
    _land(_revised(orders), landing, "append")
    second = run_available_now(spark, spec, checkpoint=ckpt)  # picks up only the new files
    assert sum(r.row_count for r in second) == _revised(orders).count()
    return spark.read.schema(ORDERS_DDL).parquet(f"{base}/target")


def stream_dedup_across_batches(spark, d):
    """The latest order of each customer over a stream of three micro-batches in which the newest
    orders come first, and each customer's first-seen row appended once: as over one batch."""
    from .streaming import run_available_now

    base = scratch_path(spark, "stream_dedup")
    orders = _table(spark, d, "orders")
    for part in (orders.filter(F.col("o_orderdate") > _ts(CUT)), _earlier(orders),
                 orders.filter(F.col("o_orderpriority") == URGENT)):
        _land(part.coalesce(1), f"{base}/landing", "append")
    out = []
    for name, dedup, target in (
            ("latest", {"order_by": "o_orderdate", "tie_breakers": ["o_orderkey"]}, {"write_mode": "merge", "merge_keys": ["o_custkey"]}),
            ("once", {}, {"write_mode": "append", "idempotent": True})):
        spec = spec_from_dict({
            "dataset_name": name,
            "source": {"type": "parquet", "options": {"path": f"{base}/landing", "maxFilesPerTrigger": "1"}, "schema": _orders_schema()},
            "transforms": [{"type": "deduplicate", "keys": ["o_custkey"], "across_batches": True, **dedup}],
            "targets": [{"type": "file", "options": {"path": f"{base}/{name}"}, **target}], "audit_path": f"{base}/audit"})
        assert len(run_available_now(spark, spec, checkpoint=f"{base}/checkpoint_{name}")) == 3
        rows = spark.read.schema(ORDERS_DDL).option("recursiveFileLookup", "true").parquet(f"{base}/{name}")
        key = F.col("o_orderkey") if name == "latest" else F.lit(None).cast("bigint")
        out.append(rows.select("o_custkey", key.alias("o_orderkey"), F.lit(name).alias("kind")))
    return out[0].unionByName(out[1])


def table_registers_touched_partitions(spark, d):
    """A table whose orders move between partitions: the catalog knows the partitions there are."""
    orders = _table(spark, d, "orders")
    t = _table_target(spark, "touched_parts", write_mode="merge", merge_keys=["o_orderkey"], partition_columns=["o_orderpriority"])
    write_target(spark, orders, t)
    urgent = F.col("o_orderpriority") == URGENT
    write_target(spark, orders.filter(urgent).withColumn("o_orderpriority", F.lit("0-MOVED")), t)
    table = t.options["table"]
    counts = spark.table(table).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))
    known = spark.sql(f"SHOW PARTITIONS {table}").select(F.split_part("partition", F.lit("="), F.lit(2)).alias("o_orderpriority"))
    return known.join(counts, "o_orderpriority", "full")


# --------------------------------------------------------------------------- runs

def _full_spec(base: str, d: str) -> dict:
    return {
        "dataset_name": "orders",
        "source": _parquet_source(f"{d}/orders.parquet", watermark_column="o_orderdate"),
        "transforms": [
            {"type": "deduplicate", "keys": ["o_custkey"], "order_by": ["o_orderdate"],
             "tie_breakers": ["o_orderkey"]},
            {"type": "add_metadata"},
        ],
        "data_quality": {"min_row_count": 1, "max_null_fraction": {"o_custkey": 0.0}},
        "targets": [{"type": "file", "options": {"path": f"{base}/target"},
                     "write_mode": "merge", "merge_keys": ["o_custkey"]}],
        "state_path": f"{base}/state", "audit_path": f"{base}/audit",
    }


def ingest_full(spark, d):
    """Stored mark → incremental scan → latest order per customer → metadata → gate → upsert."""
    base = scratch_path(spark, "ingest_full")
    st.commit_state(spark, f"{base}/state", "orders",
                    [st.StateEntry("file", "o_orderdate", "timestamp_ntz", CUT, 1)])
    run(spark, spec_from_dict(_full_spec(base, d)))
    return spark.read.parquet(f"{base}/target").select(*ORDER_COLS)


def ingest_lineitem_latest(spark, d):
    """Two incremental runs over lineitem (its line keys repeat): each batch keeps the latest
    row per (l_orderkey, l_linenumber) and merges into a target partitioned by return flag —
    outside the key, so a line whose flag changed moves partition."""
    base = scratch_path(spark, "ingest_lineitem")
    lineitem = _table(spark, d, "lineitem")
    landing = f"{base}/landing"
    _land(lineitem.filter(F.col("l_shipdate") <= _ts(CUT)), landing)
    spec = spec_from_dict({
        "dataset_name": "lineitem",
        "source": _parquet_source(landing, watermark_column="l_shipdate"),
        "transforms": [{"type": "deduplicate", "keys": ["l_orderkey", "l_linenumber"], "order_by": "l_shipdate",
                        "tie_breakers": ["l_partkey", "l_suppkey"]}],
        "targets": [{"type": "file", "options": {"path": f"{base}/target"}, "write_mode": "merge",
                     "merge_keys": ["l_orderkey", "l_linenumber"], "partition_columns": ["l_returnflag"]}],
        "state_path": f"{base}/state", "audit_path": f"{base}/audit",
    })
    run(spark, spec)
    _land(lineitem, landing)
    second = run(spark, spec)
    assert second.reports[0].extra.get("scope") == "dynamic"
    return spark.read.schema(LINEITEM_DDL).parquet(f"{base}/target")


def ingest_single_target(spark, d):
    base = scratch_path(spark, "ingest_single")
    spec = spec_from_dict(_two_target_spec(spark, base, d))
    run(spark, spec, targets=["file"])
    run(spark, spec, targets=["table"])
    return _labelled_targets(spark, spec)


def run_audit(spark, d):
    base = scratch_path(spark, "run_audit")
    spec = spec_from_dict(_gate_spec(base, f"{d}/orders.parquet", data_quality={"min_row_count": 1}))
    res = run(spark, spec)
    return (st.audit_frame(spark, f"{base}/audit").filter(F.col("run_id") == res.run_id)
            .select("dataset", "target", "row_count", F.col("dq_passed")))


QUERIES: dict[str, Query] = {
    "scan_parquet": scan_parquet,
    "scan_csv": scan_csv,
    "scan_json": scan_json,
    "scan_csv_documents": scan_csv_documents,
    "scan_json_embeddings": scan_json_embeddings,
    "scan_table": scan_table,
    "scan_table_partition_filter": scan_table_partition_filter,
    "initial_scan": initial_scan,
    "incremental_scan": incremental_scan,
    "next_watermark": next_watermark,
    "scan_custom_source": scan_custom_source,
    "decode_json_value": decode_json_value_q,
    "decode_json_value_flagged": decode_json_value_flagged,
    "incremental_overlap_scan": incremental_overlap_scan,
    "rename_columns": rename_columns_q,
    "cast_columns": cast_columns_q,
    "add_metadata": add_metadata_q,
    "drop_columns": drop_columns_q,
    "transform_chain": transform_chain,
    "dedup_any": dedup_any_q,
    "dedup_latest": dedup_latest_q,
    "dedup_latest_agg": dedup_latest_agg,
    "dq_min_row_count": dq_min_row_count,
    "dq_null_fraction": dq_null_fraction,
    "dq_expected_columns": dq_expected_columns,
    "dq_suite": dq_suite,
    "dq_gate_continue": dq_gate_continue,
    "quarantine_batch": quarantine_batch_q,
    "quarantine_rows": quarantine_rows_q,
    "quarantine_unparsed": quarantine_unparsed,
    "decode_json_value_failures": decode_json_value_failures,
    "run_metrics": run_metrics,
    "state_lookup": state_lookup,
    "state_advance": state_advance,
    "incremental_two_runs": incremental_two_runs,
    "sink_file_append": sink_file_append,
    "sink_file_overwrite": sink_file_overwrite,
    "sink_partitioned": sink_partitioned,
    "sink_manifest": sink_manifest,
    "sink_table_append": sink_table_append,
    "sink_table_overwrite": sink_table_overwrite,
    "table_repair_partitions": table_repair_partitions,
    "append_evolving_schema": append_evolving_schema,
    "table_append_evolving_schema": table_append_evolving_schema,
    "overwrite_evolving_schema": overwrite_evolving_schema,
    "fan_out": fan_out,
    "sink_custom_target": sink_custom_target,
    "append_idempotent": append_idempotent,
    "append_idempotent_moved_partition": append_idempotent_moved_partition,
    "upsert_two_level_partitions": upsert_two_level_partitions,
    "upsert_insert_only_fewer_columns": upsert_insert_only_fewer_columns,
    "rename_columns_case": rename_columns_case,
    "dedup_latest_case": dedup_latest_case,
    "run_many_shared_state": run_many_shared_state,
    "incremental_diverging_marks": incremental_diverging_marks,
    "incremental_compound_mark": incremental_compound_mark,
    "incremental_late_rows": incremental_late_rows,
    "upsert_file": upsert_file,
    "upsert_file_partitioned": upsert_file_partitioned,
    "upsert_file_moving_partitions": upsert_file_moving_partitions,
    "upsert_table": upsert_table,
    "upsert_touched_files": upsert_touched_files,
    "upsert_marks": upsert_marks,
    "upsert_marks_compacted": upsert_marks_compacted,
    "upsert_out_of_order": upsert_out_of_order,
    "stream_available_now_upsert": stream_available_now_upsert,
    "stream_dedup_across_batches": stream_dedup_across_batches,
    "table_registers_touched_partitions": table_registers_touched_partitions,
    "ingest_full": ingest_full,
    "ingest_single_target": ingest_single_target,
    "ingest_lineitem_latest": ingest_lineitem_latest,
    "run_audit": run_audit,
}

_LATEST = ("QUALIFY row_number() OVER (PARTITION BY o_custkey "
           "ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
_NULLED = f"CASE WHEN o_orderpriority <> '{URGENT}' THEN o_custkey END"
_FRACTION = f"(count(*) FILTER (WHERE o_orderpriority = '{URGENT}')) / CAST(count(*) AS DOUBLE)"
_REVISED_PRICE = (f"CASE WHEN o_orderdate >= TIMESTAMP '{REVISED_FROM}' THEN o_totalprice * 2 "
                  f"ELSE o_totalprice END AS o_totalprice")
_UPSERTED = (f"SELECT o_orderkey, o_custkey, o_orderstatus, {_REVISED_PRICE}, o_orderdate, o_orderpriority "
             f"FROM orders")
_MARKED = (f"SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderdate >= TIMESTAMP '{REVISED_FROM}' "
           f"THEN o_totalprice * 2 WHEN o_orderpriority = '{URGENT}' THEN 0.0 ELSE o_totalprice END AS o_totalprice, "
           "o_orderdate, o_orderpriority FROM orders")
_BOTH_TARGETS = "SELECT 'file' AS target, * FROM orders UNION ALL SELECT 'table' AS target, * FROM orders"

_MISFITS = (f"SELECT o_orderkey, CASE WHEN o_orderpriority <> '{URGENT}' THEN o_custkey END AS o_custkey, "
            f"CASE WHEN o_orderpriority <> '{HIGH}' THEN o_totalprice END AS o_totalprice, "
            f"CASE o_orderpriority WHEN '{URGENT}' THEN 'o_custkey' WHEN '{HIGH}' THEN 'o_totalprice' ELSE '' END AS failed, "
            f"o_orderpriority IN ('{URGENT}', '{HIGH}') AS raw_kept")

ORACLE: dict[str, str] = {
    "incremental_compound_mark": "SELECT * FROM orders",
    "incremental_late_rows": "SELECT * FROM orders",
    "quarantine_unparsed": f"{_MISFITS}, kind FROM orders CROSS JOIN (VALUES ('csv'), ('json')) k(kind)",
    "decode_json_value_failures": f"{_MISFITS}, o_orderpriority IN ('{URGENT}', '{HIGH}') AS undecodable FROM orders",
    "scan_parquet": "SELECT * FROM orders",
    "scan_csv": "SELECT * FROM orders",
    "scan_json": "SELECT * FROM orders",
    "scan_csv_documents": "SELECT * FROM documents",
    "scan_json_embeddings": "SELECT * FROM embeddings",
    "scan_table": "SELECT * FROM orders",
    "scan_table_partition_filter": "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'",
    "initial_scan": "SELECT * FROM orders",
    "incremental_scan": f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{CUT}'",
    "next_watermark": f"SELECT max(o_orderdate) AS watermark FROM orders WHERE o_orderdate > TIMESTAMP '{CUT}'",
    "scan_custom_source": "SELECT * FROM orders",
    "decode_json_value": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "decode_json_value_flagged": (
        "SELECT event_id, ts, CAST(json_extract(props, '$.k') AS BIGINT) AS k, "
        "json_extract(props, '$.k') IS NULL AS _undecodable FROM events"),
    "incremental_overlap_scan": f"SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{CUT}'",
    "append_idempotent_moved_partition": "SELECT o_orderkey, 'b' AS load_day FROM orders",
    "upsert_two_level_partitions": f"""
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '{REVISED_FROM}' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
FROM orders WHERE o_orderdate <= TIMESTAMP '{CUT}' OR o_orderdate >= TIMESTAMP '{REVISED_FROM}'""",
    "upsert_insert_only_fewer_columns":
        f"SELECT o_orderkey, CASE WHEN o_orderdate <= TIMESTAMP '{CUT}' THEN o_totalprice END AS o_totalprice FROM orders",
    "rename_columns_case": "SELECT o_orderkey AS k, o_custkey AS c FROM orders",
    "dedup_latest_case": f"SELECT o_custkey, o_orderkey FROM orders {_LATEST}",
    "run_many_shared_state": """
SELECT 'ds' || lpad(CAST(i AS VARCHAR), 2, '0') AS dataset, (SELECT max(o_orderkey) FROM orders) AS mark,
       CAST(1 AS BIGINT) AS audits FROM range(12) t(i)""",
    "incremental_diverging_marks": """
WITH cuts AS (SELECT quantile_disc(o_orderkey, 1/3) AS a, quantile_disc(o_orderkey, 2/3) AS b FROM orders),
runs(target, run, lo, hi) AS (
  SELECT 'one', 1, -1, a FROM cuts UNION ALL SELECT 'one', 2, a, b FROM cuts UNION ALL SELECT 'one', 3, b, 9e18 FROM cuts
  UNION ALL SELECT 'two', 1, -1, a FROM cuts UNION ALL SELECT 'two', 2, a, 9e18 FROM cuts),
picked AS (
  SELECT target, run, o_custkey, o_orderkey FROM runs JOIN orders ON o_orderkey > lo AND o_orderkey <= hi
  QUALIFY row_number() OVER (PARTITION BY target, run, o_custkey ORDER BY o_totalprice DESC, o_orderkey DESC) = 1)
SELECT o_custkey, o_orderkey, target FROM picked
QUALIFY row_number() OVER (PARTITION BY target, o_custkey ORDER BY run DESC) = 1""",
    "rename_columns": ("SELECT o_orderkey AS o_custkey, o_custkey AS o_orderkey, o_orderstatus, o_totalprice, "
                       "o_orderdate, o_orderpriority FROM orders"),
    "cast_columns": ("SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS prio, "
                     "TRY_CAST(o_orderstatus AS INTEGER) AS bad FROM orders"),
    "add_metadata": "SELECT o_orderkey, 'orders' AS _dataset_name, true AS has_ingested_at FROM orders",
    "drop_columns": "SELECT * EXCLUDE (o_orderpriority) FROM orders",
    "transform_chain": ("SELECT o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount "
                        f"FROM orders {_LATEST}"),
    "dedup_any": "SELECT DISTINCT o_custkey FROM orders",
    "dedup_latest": f"SELECT * FROM orders {_LATEST}",
    "dedup_latest_agg": f"SELECT * FROM orders {_LATEST}",
    "dq_min_row_count": (
        "SELECT 'orders' AS dataset, 'min_row_count' AS check_name, CAST(NULL AS VARCHAR) AS column_name, "
        "CAST(count(*) AS DOUBLE) AS observed, CAST(1000000 AS DOUBLE) AS threshold, "
        "count(*) >= 1000000 AS passed, CASE WHEN count(*) >= 1000000 THEN 'ok' "
        "ELSE 'row_count=' || count(*) || ' < min_row_count=1000000' END AS detail FROM orders"),
    "dq_null_fraction": (
        "SELECT 'orders' AS dataset, 'max_null_fraction' AS check_name, 'o_custkey' AS column_name, "
        f"{_FRACTION} AS observed, 0.1::DOUBLE AS threshold, NOT ({_FRACTION} > 0.1) AS passed, "
        f"CASE WHEN {_FRACTION} > 0.1 THEN 'column=o_custkey null_fraction=' || printf('%.4f', {_FRACTION}) "
        "|| ' > max=0.1' ELSE 'ok' END AS detail FROM orders"),
    "dq_expected_columns": (
        "SELECT 'orders' AS dataset, 'schema_validation' AS check_name, c AS column_name, "
        "CAST(NULL AS DOUBLE) AS observed, CAST(NULL AS DOUBLE) AS threshold, ok AS passed, detail "
        "FROM (VALUES ('o_orderkey', true, 'ok'), "
        "('o_custkey', false, 'column ''o_custkey'' has type bigint, expected int'), "
        "('zz', false, 'missing expected column ''zz''')) v(c, ok, detail)"),
    "dq_suite": (
        "SELECT 'min_row_count' AS check_name, count(*) >= 1 AS passed FROM orders "
        f"UNION ALL SELECT 'max_null_fraction', NOT ({_FRACTION} > 0.1) FROM orders "
        "UNION ALL SELECT 'schema_validation', false"),
    "dq_gate_continue": f"SELECT o_orderkey, {_NULLED} AS o_custkey FROM orders",
    "quarantine_batch": (
        f"SELECT o_orderkey, {_NULLED} AS o_custkey, 'column=o_custkey null_fraction=' || "
        f"(SELECT printf('%.4f', {_FRACTION}) FROM orders) || ' > max=0.1' AS _dlq_reason FROM orders"),
    "quarantine_rows": (
        f"SELECT o_orderkey, CASE WHEN o_orderpriority = '{URGENT}' THEN 'null o_custkey' ELSE '' END "
        "AS _dlq_reason FROM orders"),
    "run_metrics": ("SELECT 'ingestion.row_count' AS metric, CAST(count(*) AS DOUBLE) AS value FROM orders "
                    "UNION ALL SELECT 'ingestion.dq_violations', CAST(1 AS DOUBLE)"),
    "state_lookup": "SELECT 'orders' AS dataset, 'file' AS target, max(o_orderdate) AS watermark FROM orders",
    "state_advance": f"SELECT max(o_orderdate) AS watermark FROM orders WHERE o_orderdate <= TIMESTAMP '{CUT}'",
    "incremental_two_runs": (
        f"SELECT o_orderkey, o_orderdate, CASE WHEN o_orderdate > TIMESTAMP '{CUT}' THEN o_totalprice * 2 "
        "ELSE o_totalprice END AS o_totalprice FROM orders"),
    "sink_file_append": "SELECT * FROM orders",
    "sink_file_overwrite": "SELECT * FROM orders",
    "sink_partitioned": "SELECT * FROM events",
    "sink_manifest": "SELECT count(*) AS row_count, true AS checksum_verified FROM orders",
    "sink_table_append": "SELECT * FROM orders",
    "sink_table_overwrite": "SELECT * FROM orders",
    "table_repair_partitions": "SELECT * FROM events",
    "append_evolving_schema": (
        f"SELECT o_orderkey, CASE WHEN o_orderdate > TIMESTAMP '{CUT}' THEN o_orderstatus END AS o_orderstatus "
        "FROM orders"),
    "table_append_evolving_schema": (
        f"SELECT o_orderkey, CASE WHEN o_orderdate > TIMESTAMP '{CUT}' THEN o_orderstatus END AS o_orderstatus "
        "FROM orders"),
    "overwrite_evolving_schema": "SELECT o_orderkey, o_orderstatus FROM orders",
    "fan_out": _BOTH_TARGETS,
    "sink_custom_target": "SELECT * FROM orders",
    "append_idempotent": (
        f"SELECT o_orderkey, CAST(CASE WHEN o_orderdate > TIMESTAMP '{CUT}' THEN 2 ELSE 1 END AS INTEGER) "
        "AS _batch_id FROM orders"),
    "upsert_file": _UPSERTED,
    "upsert_file_partitioned": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' AND "
        f"o_orderdate >= TIMESTAMP '{REVISED_FROM}' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, "
        "o_orderdate, o_orderpriority FROM orders"),
    "upsert_file_moving_partitions": (
        f"SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderpriority = '{URGENT}' AND "
        f"o_orderdate >= TIMESTAMP '{REVISED_FROM}' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, "
        f"o_orderdate, CASE WHEN o_orderpriority = '{URGENT}' AND o_orderdate >= TIMESTAMP '{REVISED_FROM}' "
        f"THEN '{HIGH}' ELSE o_orderpriority END AS o_orderpriority FROM orders"),
    "upsert_table": _UPSERTED,
    "upsert_touched_files": _UPSERTED,
    "upsert_marks": _MARKED,
    "upsert_marks_compacted": _MARKED,
    "upsert_out_of_order": (
        "WITH v AS (SELECT o_orderkey, o_totalprice, CASE WHEN o_orderpriority = '" + URGENT + "' THEN 3 "
        f"WHEN o_orderstatus = 'F' OR o_orderdate >= TIMESTAMP '{REVISED_FROM}' THEN 2 ELSE 1 END AS version FROM orders) "
        "SELECT o_orderkey, o_totalprice * version AS o_totalprice, version, target "
        "FROM v CROSS JOIN (VALUES ('files'), ('table')) t(target)"),
    "stream_available_now_upsert": _UPSERTED,
    "stream_dedup_across_batches": (
        "SELECT o_custkey, o_orderkey, 'latest' AS kind FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey "
        "ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 "
        "UNION ALL SELECT DISTINCT o_custkey, CAST(NULL AS BIGINT), 'once' FROM orders"),
    "table_registers_touched_partitions": (
        f"SELECT CASE WHEN o_orderpriority = '{URGENT}' THEN '0-MOVED' ELSE o_orderpriority END AS o_orderpriority, "
        "count(*) AS orders FROM orders GROUP BY 1"),
    "ingest_full": f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{CUT}' {_LATEST}",
    "ingest_single_target": _BOTH_TARGETS,
    "ingest_lineitem_latest": ("SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, "
                               "l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1"),
    "run_audit": "SELECT 'orders' AS dataset, 'file' AS target, count(*) AS row_count, true AS dq_passed FROM orders",
}
