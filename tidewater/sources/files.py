"""File sources: Parquet, CSV, JSON lines on any Hadoop-compatible path."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..errors import MissingOptionError
from ..spec import SourceSpec
from .parsing import declared, flag_unparsed, permissive, wants_quarantine, with_raw

# Reader defaults that apply unless the spec overrides them.
CSV_DEFAULTS = {"header": "true", "inferSchema": "true"}


def read_files(spark: SparkSession, source: SourceSpec, fmt: str) -> DataFrame:
    options = {k: str(v) for k, v in source.options.items()}
    path = options.pop("path", None)
    if not path:
        raise MissingOptionError("File source requires 'path' option")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        options.setdefault("header", CSV_DEFAULTS["header"])
    if fmt in ("csv", "json") and wants_quarantine(source):
        struct = declared(source)
        options.pop("inferSchema", None)
        return flag_unparsed(reader.schema(with_raw(struct)).options(**permissive(options)).load(path), struct, options, fmt)
    if fmt in ("csv", "json") and source.on_parse_error == "fail":
        options["mode"] = "FAILFAST"
    schema = source.struct_type()
    # A declared schema beats inference for text formats: no inference job, no drift
    # (CSV inference would turn bigint into int and dates into zoned timestamps).
    if schema is not None and source.apply_schema and fmt in ("csv", "json"):
        reader = reader.schema(schema)
        options.pop("inferSchema", None)
    elif fmt == "csv":
        options.setdefault("inferSchema", CSV_DEFAULTS["inferSchema"])
    return reader.options(**options).load(path)
