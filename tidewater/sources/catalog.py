"""Sources with a catalog entry: metastore tables and Delta tables."""
from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..errors import MissingOptionError
from ..places import place_of
from ..spec import SourceSpec

log = logging.getLogger("tidewater.sources")


def partition_fields(spark: SparkSession, table: str) -> StructType:
    """The columns a table's folders are split by; empty for a table without partitions."""
    split_by = {c.name for c in spark.catalog.listColumns(table) if c.isPartition}
    return StructType([f for f in spark.table(table).schema.fields if f.name in split_by])


def only_partitions(spark: SparkSession, predicate: str, fields: StructType) -> bool:
    """Does a predicate name partition columns alone, so that folders are left out at planning?"""
    if not fields.fields:
        return False
    try:
        spark.createDataFrame([], fields).filter(predicate)
    except AnalysisException:
        return False
    return True


def read_table(spark: SparkSession, source: SourceSpec) -> DataFrame:
    """A table's rows, those of some partitions where ``partition_filter`` says which."""
    name = str(source.options.get("table") or "")
    if not name:
        raise MissingOptionError("a table source names its 'table'")
    wanted = source.options.get("partition_filter")
    if not wanted:
        return spark.table(name)
    if not only_partitions(spark, wanted, partition_fields(spark, name)):
        log.warning("partition_filter reads more than the partitions it keeps", extra={"table": name, "predicate": wanted})
    return spark.table(name).where(wanted)


def read_delta(spark: SparkSession, source: SourceSpec) -> DataFrame:
    """A Delta table's rows, with what else is in the options (a version or a time to read as of).

    Needs the Delta connector on the classpath."""
    at = place_of(source.options, "Delta source", names_win=True)
    how = {k: str(v) for k, v in source.options.items() if k not in ("table", "path")}
    delta = spark.read.format("delta").options(**how)
    return delta.load(at.path) if at.table is None else delta.table(at.table)
