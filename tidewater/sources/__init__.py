"""Sources: one function per source type, a registry for user-defined types, and the
incremental (high-water mark) read."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..errors import UnknownConnectorError
from ..functions import typed
from ..spec import SOURCE_ALIASES, SourceSpec
from .catalog import read_delta, read_table
from .files import read_files
from .jdbc import read_jdbc
from .messages import decode_json_value, read_kafka

SourceFn = Callable[[SparkSession, SourceSpec], DataFrame]

_REGISTRY: dict[str, SourceFn] = {
    "parquet": lambda spark, s: read_files(spark, s, "parquet"),
    "csv": lambda spark, s: read_files(spark, s, "csv"),
    "json": lambda spark, s: read_files(spark, s, "json"),
    "jdbc": read_jdbc,
    "table": read_table,
    "kafka": read_kafka,
    "delta": read_delta,
}


def register_source(kind: str, fn: SourceFn) -> None:
    """Add or replace a source type. ``fn(spark, source_spec) -> DataFrame``."""
    _REGISTRY[kind.lower()] = fn


def read_source(spark: SparkSession, source: SourceSpec) -> DataFrame:
    """A lazy DataFrame over the source (type aliases such as ``s3_parquet`` accepted)."""
    kind = source.type.lower()
    fn = _REGISTRY.get(SOURCE_ALIASES.get(kind, kind))
    if fn is None:
        raise UnknownConnectorError(f"Unsupported source type: {source.type}")
    return fn(spark, source)


def read_incremental(spark: SparkSession, source: SourceSpec,
                     watermark: tuple[str, str] | None) -> DataFrame:
    """Full read when there is no stored watermark or no watermark column; otherwise only
    rows strictly past it (``>=`` with ``watermark_overlap``).

    ``watermark`` is ``(text, type_ddl)`` as kept in the state table. The predicate sits on
    the bare column against a folded literal, so Parquet/JDBC scans receive it as a
    pushed filter.
    """
    df = read_source(spark, source)
    column = source.watermark_column
    if column and watermark is not None:
        tie = df[source.watermark_tie_column] if source.watermark_tie_column else None
        df = df.filter(typed.past(df[column], tie, watermark, inclusive=source.watermark_overlap))
    return df


__all__ = [
    "read_source", "read_incremental", "register_source",
    "decode_json_value", "read_files", "read_jdbc", "read_table", "read_kafka", "read_delta",
]
