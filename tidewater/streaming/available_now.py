"""Streaming form of the incremental load.

A file source is read with ``readStream``; ``trigger(availableNow=True)`` processes
whatever landed since the last start and stops. Each micro-batch goes through the same
transform → profile → gate → write code as a batch run (``foreachBatch``), with the
stream checkpoint taking the place of the high-water mark and the micro-batch id giving
replay-safe appends (``idempotent`` targets) — a replayed micro-batch overwrites its own
``_batch_id`` partition, and upserts are naturally idempotent.

A ``deduplicate`` transform holds within a micro-batch. With ``across_batches: true`` it holds over the
whole stream: it, and the transforms before it, run on the stream itself, and the keys seen so
far live in the state store beside the checkpoint (JVM operators: a streaming deduplication, or for
the latest row a ``max_by`` aggregate in update mode). The latest row of a key is then given out
again whenever the key appears, so the targets must merge on it; a late old row changes nothing.
``within`` (an interval) with ``event_time`` (a column) bounds the state of a plain
deduplication: repeats further apart than that are not looked for.
"""
from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..errors import SpecError
from ..operators.chain import apply_chain, compile_chain, is_wide
from ..plans.ingest import RunResult, process_batch, select_targets
from ..session import work_dir
from ..sources.parsing import declared, flag_unparsed, permissive, split_unparsed, wants_quarantine, with_raw
from ..spec import DatasetSpec

# File source types the stream can read (besides Kafka).
STREAM_FORMATS = ("parquet", "csv", "json")


def stream_frame(spark: SparkSession, spec: DatasetSpec) -> DataFrame:
    src = spec.source
    if src.type == "kafka":
        # offsets live in the stream checkpoint; needs the Kafka connector on the classpath
        from ..sources.messages import UNDECODABLE, decode_json_value

        options = dict(src.options)
        schema = options.pop("value_schema", None)
        keep = options.pop("keep_columns", None)
        flag = options.pop("flag_undecodable", None)
        raw = spark.readStream.format("kafka").options(**{k: str(v) for k, v in options.items()}).load()
        if not schema:
            return raw
        return decode_json_value(raw, schema, "value", keep=list(keep or []),
                                 flag_column=UNDECODABLE if str(flag).lower() == "true" else None,
                                 failures=wants_quarantine(src))
    if src.type not in STREAM_FORMATS:
        raise SpecError(f"streaming runs read file sources {STREAM_FORMATS}, not {src.type!r}")
    options = {k: str(v) for k, v in src.options.items()}
    path = options.pop("path", None)
    if not path:
        raise SpecError("File source requires 'path' option")
    schema = src.struct_type()
    if schema is None:
        if src.type != "parquet":
            raise SpecError("a streaming csv/json source needs a declared schema")
        schema = spark.read.parquet(path).schema  # footer of the files already there
    if src.type == "csv":
        options.setdefault("header", "true")
    if wants_quarantine(src):
        stream = spark.readStream.format(src.type).schema(with_raw(declared(src))).options(**permissive(options)).load(path)
        return flag_unparsed(stream, declared(src), options, src.type)
    if src.on_parse_error == "fail" and src.type != "parquet":
        options["mode"] = "FAILFAST"
    return spark.readStream.format(src.type).schema(schema).options(**options).load(path)


def _stateful_chain(stream: DataFrame, spec: DatasetSpec, fns: list) -> tuple[DataFrame, list, str]:
    """(the stream with its transforms up to one that holds over all batches, the transforms left
    for each batch, output mode)."""
    at = [i for i, t in enumerate(spec.transforms) if t.type == "deduplicate" and t.params.get("across_batches")]
    if not at:
        return stream, fns, "append"
    if len(at) > 1 or any(t.type == "deduplicate" for t in spec.transforms[: at[0]]):
        raise SpecError("a stream keeps one deduplication across batches, the first one of its transforms")
    if wants_quarantine(spec.source):
        raise SpecError("records that do not parse leave the stream by batch; deduplicate across batches after them is not supported")
    p = spec.transforms[at[0]].params
    keys = list(p["keys"])
    before = apply_chain(stream, fns[: at[0]])

    if p.get("order_by"):
        loose = [t.id for t in spec.targets if not t.is_merge or not set(t.merge_keys) <= set(keys)]
        if loose:
            raise SpecError(f"the latest row of a key is given out whenever it changes; these targets do not merge on the key: {loose}")
        return apply_chain(before, [fns[at[0]]]), fns[at[0] + 1:], "update"
    if p.get("within"):
        if not p.get("event_time"):
            raise SpecError("deduplicate within an interval needs an event_time column")
        bounded = before.withWatermark(p["event_time"], str(p["within"])).dropDuplicatesWithinWatermark(keys)
        return bounded, fns[at[0] + 1:], "append"
    return before.dropDuplicates(keys), fns[at[0] + 1:], "append"


def run_available_now(spark: SparkSession, spec: DatasetSpec, *, checkpoint: str | None = None,
                      targets: list[str] | None = None, run_time: _dt.datetime | None = None) -> list[RunResult]:
    """Process every file that is new since the last start, then stop."""
    selected = select_targets(spec, targets)
    run_time = run_time or _dt.datetime.now(_dt.timezone.utc)
    checkpoint = checkpoint or f"{work_dir(spark)}/tidewater_streams/{spec.dataset_name}"
    stream, fns, mode = _stateful_chain(stream_frame(spark, spec), spec,
                                        compile_chain(spec.transforms, spec.dataset_name, run_time))
    stateful = len(fns) < len(spec.transforms)
    results: list[RunResult] = []

    def _batch(batch_df: DataFrame, batch_id: int) -> None:
        if stateful:
            # dealt again: the batch claims the order in which the state left its rows, under names that
            # it no longer has, and so could not be cached
            batch_df = batch_df.repartition(spark.sparkContext.defaultParallelism)
        good, unparsed = split_unparsed(batch_df) if wants_quarantine(spec.source) else (batch_df, None)
        df = apply_chain(good, fns)
        results.append(process_batch(
            batch_df.sparkSession, spec, df, selected, run_id=uuid.uuid4().hex, run_time=run_time,
            # a stateful stream is not run again for each reader of its batch
            persist=is_wide(spec.transforms) or len(selected) > 1, batch_id=int(batch_id) + 1, unparsed=unparsed))

    query = (stream.writeStream
             .outputMode(mode)
             .foreachBatch(_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return results
