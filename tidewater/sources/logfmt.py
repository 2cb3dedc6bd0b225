"""A sample user-defined source: folders of ``key=value`` text lines (partitioned or not).

Plain DataFrame work over Spark's text reader; register it with
``register_source("logfmt", read_logfmt)``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import MissingOptionError, SpecError
from ..spec import SourceSpec


def read_logfmt(spark: SparkSession, source: SourceSpec) -> DataFrame:
    """The declared columns; a key that a line lacks is null. Values are URL-encoded, so a
    space or ``=`` inside one is data. Partition columns come from folder names and keep
    Spark's partition pruning."""
    path, schema = source.options.get("path"), source.struct_type()
    if not path:
        raise MissingOptionError("logfmt source requires 'path' option")
    if schema is None:
        raise SpecError("logfmt source needs a declared schema")
    lines = spark.read.text(str(path))
    pairs = F.str_to_map(F.col("value"), F.lit(" "), F.lit("="))
    return (lines.withColumn("__pairs", pairs)
            .select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in lines.columns[1:]
                      else F.url_decode(F.try_element_at("__pairs", F.lit(f.name))).cast(f.dataType).alias(f.name)
                      for f in schema.fields]))
