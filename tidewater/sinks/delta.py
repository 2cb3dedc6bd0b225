"""Delta Lake targets (need the Delta connector on the classpath).

Append evolves the schema (``mergeSchema``), overwrite replaces it (``overwriteSchema``),
and merge is a native row-level ``MERGE INTO … UPDATE SET * / INSERT *``: matched rows
are updated, others inserted. Exactly one of ``table`` or ``path`` must be given.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .. import fs
from ..places import Place, place_of
from ..spec import TargetSpec
from .common import WriteContext, WriteReport, observed, observed_metrics


def _place(target: TargetSpec) -> Place:
    return place_of(target.options, "Delta target", names_win=False)


def _write(df: DataFrame, target: TargetSpec, mode: str) -> dict:
    at = _place(target)
    df, obs = observed(df, False)
    writer = df.write.format("delta").mode(mode)
    if target.options.get("schema_evolution", True):
        writer = writer.option("overwriteSchema" if mode == "overwrite" else "mergeSchema", "true")
    if target.partition_columns:
        writer = writer.partitionBy(*target.partition_columns)
    writer.saveAsTable(at.table) if at.table else writer.save(at.path)
    return observed_metrics(obs)


def _exists(spark: SparkSession, target: TargetSpec) -> bool:
    at = _place(target)
    if at.table:
        return spark.catalog.tableExists(at.table)
    return fs.exists(spark, f"{at.path.rstrip('/')}/_delta_log")


def delta_append(spark, df, target, ctx: WriteContext) -> WriteReport:
    m = _write(df, target, "append")
    return WriteReport(target.id, target.type, "append", m["rows"], _place(target).identifier)


def delta_overwrite(spark, df, target, ctx: WriteContext) -> WriteReport:
    m = _write(df, target, "overwrite")
    return WriteReport(target.id, target.type, "overwrite", m["rows"], _place(target).identifier)


def merge_into_sql(identifier: str, source_view: str, keys: list[str]) -> str:
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    return (f"MERGE INTO {identifier} AS t USING {source_view} AS s ON {on} "
            "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")


def merge_counts(history: DataFrame) -> dict[str, int]:
    """Rows a merge wrote, from the newest entry of a table's history: ``rows`` as the other upserts
    count them (changed and new ones), and each kind."""
    entry = history.select("operation", "operationMetrics").first()
    metrics = (entry["operationMetrics"] or {}) if entry and entry["operation"] == "MERGE" else {}
    counts = {short: int(metrics.get(name) or 0) for short, name in
              (("updated", "numTargetRowsUpdated"), ("inserted", "numTargetRowsInserted"), ("copied", "numTargetRowsCopied"))}
    return {"rows": counts["updated"] + counts["inserted"], **counts}


def delta_upsert(spark, df, target, ctx: WriteContext) -> WriteReport:
    if not _exists(spark, target):
        m = _write(df, target, "overwrite")
        return WriteReport(target.id, target.type, "merge", m["rows"], _place(target).identifier)
    ident = _place(target).identifier
    view = f"tidewater_merge_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(view)
    try:
        spark.sql(merge_into_sql(ident, view, list(target.merge_keys)))
    finally:
        spark.catalog.dropTempView(view)
    counts = merge_counts(spark.sql(f"DESCRIBE HISTORY {ident} LIMIT 1"))
    return WriteReport(target.id, target.type, "merge", counts.pop("rows"), ident, extra=counts)
