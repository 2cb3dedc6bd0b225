"""Per-row expressions: quarantine reasons and an order-insensitive content hash."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reason_column(not_null: list[str] | None = None, rules: dict[str, str] | None = None) -> Column:
    """``"; "``-joined reasons a row breaks; the empty string for a good row.

    ``not_null`` columns give ``null <col>``; each ``rules`` entry maps a reason to a SQL
    predicate that good rows satisfy (a NULL predicate counts as broken).
    """
    checks: list[Column] = [F.when(F.col(c).isNull(), F.lit(f"null {c}")) for c in not_null or []]
    for reason, predicate in (rules or {}).items():
        checks.append(F.when(~F.coalesce(F.expr(predicate), F.lit(False)), F.lit(reason)))
    if not checks:
        return F.lit("")
    return F.concat_ws("; ", F.filter(F.array(*checks), lambda r: r.isNotNull()))


def row_hash(columns: list[str], map_columns: set[str] | None = None) -> Column:
    """64-bit hash of one row's values (column order as given). Map values, which Spark
    cannot hash, enter as their entries sorted by key."""
    maps = map_columns or set()
    return F.xxhash64(*[F.array_sort(F.map_entries(F.col(f"`{c}`"))) if c in maps else F.col(f"`{c}`")
                        for c in columns])


def content_hash(columns: list[str], map_columns: set[str] | None = None) -> Column:
    """Aggregate: order-insensitive hash of a whole frame.

    A sum of row hashes in ``decimal(38,0)`` — a ``bigint`` sum would overflow under ANSI —
    so it can be computed partially on every partition and does not depend on the
    row order or partitioning of the data.
    """
    return F.sum(row_hash(columns, map_columns).cast("decimal(38,0)"))


def literal_frame(spark, rows: list[tuple], schema):
    """A small DataFrame built from literals inside the JVM (``inline`` of an array of
    structs) — no Python worker is started, unlike ``createDataFrame`` of a list."""
    from pyspark.sql.types import StructType

    assert isinstance(schema, StructType)
    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    structs = [
        F.struct(*[(F.lit(v) if v is not None else F.lit(None)).cast(f.dataType).alias(f.name)
                   for v, f in zip(row, schema.fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs))).select(
        *[F.col(f.name) for f in schema.fields])
