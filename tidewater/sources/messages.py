"""Message payloads: Kafka batch reads and JSON value decoding."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from ..spec import SourceSpec
from .parsing import RAW, UNPARSED, failed_fields, permissive, wants_quarantine, with_raw

UNDECODABLE = "_undecodable"


def value_schema(schema) -> StructType:
    """A struct from a Spark JSON schema dict, a JSON string or a DDL string."""
    if isinstance(schema, StructType):
        return schema
    if isinstance(schema, dict):
        return StructType.fromJson(schema)
    text = str(schema).strip()
    if text.startswith("{"):
        import json

        return StructType.fromJson(json.loads(text))
    parsed = _parse_datatype_string(text)
    if not isinstance(parsed, StructType):
        raise ValueError(f"value schema must be a struct, got {parsed.simpleString()}")
    return parsed


def decode_json_value(df: DataFrame, schema, value_col: str = "value",
                      keep: list[str] | None = None, flag_column: str | None = None,
                      failures: bool = False) -> DataFrame:
    """Decode a bytes/string JSON payload into top-level columns.

    ``keep`` names envelope columns to carry along (by default all are dropped).
    With ``flag_column`` set, rows whose payload is null, not a JSON object of that shape, or
    has a field that does not fit its type get ``flag_column = true`` so the caller can
    quarantine them; otherwise such a field (or all of them) decodes to NULL.
    ``failures`` adds the payload's text and the names of the failed fields (see ``parsing``).
    """
    struct = value_schema(schema)
    raw = F.col(value_col).cast("string")
    # without a flag only the wanted fields are parsed; with one a bad field must be noticed
    noted = bool(flag_column) or failures
    decoded = F.from_json(raw, with_raw(struct) if noted else struct,
                          permissive({}) if noted else {"mode": "PERMISSIVE"})
    cols = [F.col(c) for c in keep or []]
    out = df.select(*cols, decoded.alias("__data"), raw.alias("__text"))
    fields = [F.col(f"__data.`{f.name}`").alias(f.name) for f in struct.fields]
    extra = []
    # a payload that is valid JSON but shares no field with the schema is bad as well
    all_null = F.lit(True)
    for f in struct.fields:
        all_null = all_null & F.col(f"__data.`{f.name}`").isNull()
    bad = F.col("__text").isNull() | F.col("__data").isNull() | all_null
    if noted:
        bad = bad | F.col(f"__data.{RAW}").isNotNull()
    if flag_column:
        extra.append(bad.alias(flag_column))
    if failures:
        text = F.when(bad, F.coalesce(F.col("__text"), F.lit("")))
        extra += [text.alias(RAW), failed_fields(struct, text, lambda n: F.col(f"__data.`{n}`"), {}, "json").alias(UNPARSED)]
    return out.select(*[F.col(c) for c in keep or []], *fields, *extra)


def read_kafka(spark: SparkSession, source: SourceSpec) -> DataFrame:
    """Batch read between the offsets in the options; decode when ``value_schema`` is set.

    Needs the Kafka connector on the classpath.
    """
    options = {k: v for k, v in source.options.items()}
    schema = options.pop("value_schema", None)
    keep = options.pop("keep_columns", None)
    flag = options.pop("flag_undecodable", None)
    raw = spark.read.format("kafka").options(**{k: str(v) for k, v in options.items()}).load()
    if not schema:
        return raw
    # with flag_undecodable, a quarantine rule such as ``NOT _undecodable`` routes bad payloads
    return decode_json_value(raw, schema, "value", keep=list(keep or []),
                             flag_column=UNDECODABLE if str(flag).lower() == "true" else None,
                             failures=wants_quarantine(source))
