"""Typed high-water marks.

A watermark is stored as text next to the DDL of its column type and is always
rendered and parsed by Spark expressions, never through a Python ``datetime``:

* ``timestamp`` (session-zoned) is kept as epoch microseconds, so a session in another
  time zone reads back the same instant;
* every other type uses Spark's own ``CAST(... AS STRING)`` which round-trips exactly
  (``timestamp_ntz``, ``date``, integral, decimal, double, string).

A compound mark orders rows by a column and, where that ties, by a second one. Its type is
``struct<mark:…,tie:…>``, its text a JSON object of both parts' texts (a null tie left out).

The parsed value is a constant expression, so Catalyst folds it into a literal and the
comparison on the bare column reaches the scan as a pushed filter.
"""
from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType, TimestampType, _parse_datatype_string

MARK, TIE = "mark", "tie"


def _is_zoned_timestamp(dtype: DataType) -> bool:
    return isinstance(dtype, TimestampType)


def render(col: Column, dtype: DataType) -> Column:
    """Expression turning a typed value into its stored text form."""
    if isinstance(dtype, StructType):
        parts = [render(col.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(col.isNotNull(), F.to_json(F.struct(*parts)))
    if _is_zoned_timestamp(dtype):
        return F.unix_micros(col).cast("string")
    return col.cast("string")


def parse(text: str, type_ddl: str) -> Column:
    """Constant expression turning stored text back into a typed literal."""
    dtype = _parse_datatype_string(type_ddl)
    if isinstance(dtype, StructType):
        texts = json.loads(text)
        return F.struct(*[(parse(texts[f.name], f.dataType.simpleString()) if texts.get(f.name) is not None
                           else F.lit(None).cast(f.dataType)).alias(f.name) for f in dtype.fields])
    if _is_zoned_timestamp(dtype):
        return F.timestamp_micros(F.lit(int(text)))
    if type_ddl.lower() == "string":
        return F.lit(text)
    return F.lit(text).cast(dtype)


def after(col: Column, text: str, type_ddl: str, inclusive: bool = False) -> Column:
    """``col > watermark`` (or ``>=`` for overlap reads) with a typed literal."""
    bound = parse(text, type_ddl)
    return col >= bound if inclusive else col > bound


def mark_value(column: str, tie_column: str | None) -> Column:
    """What a row's mark is: the column, or both columns as one value that is null where the first is."""
    first = F.col(f"`{column}`")
    if tie_column is None:
        return first
    return F.when(first.isNotNull(), F.struct(first.alias(MARK), F.col(f"`{tie_column}`").alias(TIE)))


def past(first: Column, tie: Column | None, mark: tuple[str, str], inclusive: bool = False) -> Column:
    """Is a row past a stored mark? For a compound mark, later by the first column or as late and
    greater by the second; the range of the first column is a condition of its own, so it reaches
    the scan. A mark stored before there was a tie column has taken all rows that tie with it."""
    text, type_ddl = mark
    if not isinstance(_parse_datatype_string(type_ddl), StructType):
        return after(first, text, type_ddl, inclusive)
    if tie is None:  # the tie column was given up: rows at the mark are read again rather than lost
        return first >= parse(text, type_ddl).getField(MARK)
    bound = parse(text, type_ddl)
    low, least = bound.getField(MARK), bound.getField(TIE)
    if json.loads(text).get(TIE) is None:  # every tie is greater than none
        beyond = F.lit(True) if inclusive else tie.isNotNull()
    else:
        beyond = tie >= least if inclusive else tie > least
    return (first >= low) & ((first > low) | beyond)


def newer(new: tuple[str, str], old: tuple[str, str]) -> Column:
    """Constant: is a new mark past a stored one? Between a plain and a compound mark the first parts
    decide, and the new kind wins a tie."""
    kinds = [isinstance(_parse_datatype_string(t), StructType) for _, t in (new, old)]
    a, b = parse(*new), parse(*old)
    if kinds[0] == kinds[1]:
        return a > b
    return (a.getField(MARK) if kinds[0] else a) >= (b.getField(MARK) if kinds[1] else b)
