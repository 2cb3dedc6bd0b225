"""A sample user-defined target: ``key=value`` text lines, one per row.

The counterpart of ``sources.logfmt``; register it with
``register_target("logfmt", append=append_logfmt, overwrite=overwrite_logfmt)``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import MissingOptionError
from ..spec import TargetSpec
from .common import WriteContext, WriteReport, observed, observed_metrics


def _write(df: DataFrame, target: TargetSpec, mode: str) -> WriteReport:
    path = target.options.get("path")
    if not path:
        raise MissingOptionError("logfmt target requires 'path' option")
    parts = list(target.partition_columns)
    rows, obs = observed(df, False)
    pairs = [F.concat(F.lit(f"{c}="), F.url_encode(F.col(f"`{c}`").cast("string"))) for c in df.columns if c not in parts]
    lines = rows.select(F.concat_ws(" ", *pairs).alias("value"), *[F.col(f"`{c}`") for c in parts])  # nulls are left out
    writer = lines.write.mode(mode)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.text(str(path))
    return WriteReport(target.id, target.type, mode, observed_metrics(obs)["rows"], str(path))


def append_logfmt(spark: SparkSession, df: DataFrame, target: TargetSpec, ctx: WriteContext) -> WriteReport:
    return _write(df, target, "append")


def overwrite_logfmt(spark: SparkSession, df: DataFrame, target: TargetSpec, ctx: WriteContext) -> WriteReport:
    return _write(df, target, "overwrite")
