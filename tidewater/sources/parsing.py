"""Records that do not parse: found field by field, kept with their raw text.

With ``on_parse_error: quarantine`` a CSV, JSON or message source reads with Spark's permissive
parser and its corrupt-record column. A record that column holds is parsed once more into plain
strings; the fields that have text but no value are the ones that failed. A record that is
malformed as a whole (wrong number of tokens, no JSON object, null payload) has ``*``.

Both columns are hidden from transforms and rules: ``split_unparsed`` takes the failed records
off before them, so a failed record can neither win a deduplication nor reach a target.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..errors import SpecError
from ..spec import SourceSpec

RAW = "__raw"
UNPARSED = "__unparsed"
WHOLE = "*"
#: Source types whose records can fail to parse.
PARSED_SOURCES = ("csv", "json", "kafka")
#: Options of the file reader that the parser of single records does not take.
FILE_ONLY = ("header", "inferSchema", "mode", "columnNameOfCorruptRecord", "multiLine", "enforceSchema", "columnPruning",
             "recursiveFileLookup", "pathGlobFilter", "modifiedBefore", "modifiedAfter", "samplingRatio", "lineSep",
             "maxFilesPerTrigger", "maxBytesPerTrigger", "ignoreMissingFiles", "ignoreCorruptFiles")


def with_raw(struct: StructType) -> StructType:
    return StructType([*struct.fields, StructField(RAW, StringType())])


def permissive(options: dict[str, str]) -> dict[str, str]:
    """Reader options that keep a failed record's text. Every column is parsed whatever the
    query selects, so a record fails or not alike in every job."""
    return {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW, "columnPruning": "false"}


def _record_options(options: dict[str, str]) -> dict[str, str]:
    left_out = {o.lower() for o in FILE_ONLY}
    return {k: v for k, v in options.items() if k.lower() not in left_out}


def failed_fields(struct: StructType, raw: Column, value, options: dict[str, str], fmt: str) -> Column:
    """Names of the fields of a raw record that have text but no value; ``value(name)`` is the
    typed column. Empty for a record that parsed."""
    texts = StructType([StructField(f.name, StringType()) for f in struct.fields])
    again = (F.from_csv(raw, texts.toDDL(), _record_options(options)) if fmt == "csv"
             else F.from_json(raw, texts, _record_options(options)))
    names = F.filter(F.array(*[F.when(value(f.name).isNull() & again.getField(f.name).isNotNull(), F.lit(f.name))
                               for f in struct.fields]), lambda n: n.isNotNull())
    none = F.array().cast(ArrayType(StringType()))
    return F.when(raw.isNull(), none).when(F.size(names) == 0, F.array(F.lit(WHOLE))).otherwise(names)


def flag_unparsed(df: DataFrame, struct: StructType, options: dict[str, str], fmt: str) -> DataFrame:
    """Adds UNPARSED to a frame read with ``with_raw`` and ``permissive``."""
    return df.withColumn(UNPARSED, failed_fields(struct, F.col(RAW), lambda n: F.col(f"`{n}`"), options, fmt))


def wants_quarantine(source: SourceSpec) -> bool:
    return source.on_parse_error == "quarantine"


def declared(source: SourceSpec) -> StructType:
    struct = source.struct_type()
    if struct is None:
        raise SpecError("on_parse_error needs a declared schema: inference fits the type to the failed records")
    return struct


def split_unparsed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records that parsed, without the hidden columns; failed records with them)."""
    # both filters use every field, so no column is pruned from the parser
    failed = F.size(UNPARSED) > 0
    return df.filter(~failed).drop(RAW, UNPARSED), df.filter(failed)
