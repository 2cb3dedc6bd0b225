"""The upsert plan shared by file and table targets:

    (existing LEFT ANTI JOIN batch ON keys) UNION ALL BY NAME batch

Rows of the target whose key appears in the batch are replaced by the batch rows; other
target rows are kept; columns missing on either side are NULL-filled.

Join strategy: only the batch's key columns reach the join. They are broadcast when a
size estimate from the batch row count (already known from the quality profile) is
under ``broadcast_limit``; otherwise the plan is left to a sort-merge anti join, where
AQE may still switch to broadcast at runtime or split skewed target partitions.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, IntegerType, ShortType,
                               TimestampNTZType, TimestampType, LongType, DoubleType, FloatType,
                               BooleanType, MapType, StructField, StructType)

from ..errors import DuplicateMergeKeyError, SpecError
from ..functions import row_hash

# Default broadcast ceiling for the batch key side of an upsert (bytes) and
# the assumed width of a variable-length key value.
DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024
# Fixed value: folder name Spark gives a NULL (or empty string) partition value.
DEFAULT_PARTITION_NAME = "__HIVE_DEFAULT_PARTITION__"
VARIABLE_KEY_BYTES = 64
ROW_OVERHEAD_BYTES = 16
# Fixed value: keys of a counted batch that are broadcast although nothing told its size before (bytes).
SMALL_KEYS = 10 * 1024 * 1024


def _fixed_width(dtype: DataType) -> int | None:
    if isinstance(dtype, (BooleanType, ByteType)):
        return 1
    if isinstance(dtype, ShortType):
        return 2
    if isinstance(dtype, (IntegerType, FloatType, DateType)):
        return 4
    if isinstance(dtype, (LongType, DoubleType, TimestampType, TimestampNTZType)):
        return 8
    if isinstance(dtype, DecimalType):
        return 8 if dtype.precision <= 18 else 16
    return None


def is_variable_width(batch: DataFrame, column: str) -> bool:
    return _fixed_width(batch.schema[column].dataType) is None


def key_bytes(batch: DataFrame, keys: list[str], var_bytes_per_row: float | None = None) -> float:
    """Bytes of one row of the key columns: fixed widths, plus either the measured mean of
    the variable-width ones or an assumed width."""
    width = float(ROW_OVERHEAD_BYTES)
    for k in keys:
        fixed = _fixed_width(batch.schema[k].dataType)
        if fixed is not None:
            width += fixed
        elif var_bytes_per_row is None:
            width += VARIABLE_KEY_BYTES
    return width + (var_bytes_per_row or 0.0)


def should_broadcast(batch: DataFrame, keys: list[str], batch_rows: int | None,
                     limit: int = DEFAULT_BROADCAST_LIMIT, var_key_bytes: int | None = None) -> bool:
    """True only when the batch's key side is known to fit under ``limit``.

    ``var_key_bytes`` is the measured total size of the variable-width key values (from
    the quality profile); without it, variable-width keys are assumed ``VARIABLE_KEY_BYTES``
    wide — and such an estimate is only trusted when the keys are all fixed-width.
    """
    if batch_rows is None:
        return False
    if batch_rows == 0:
        return True
    variable = [k for k in keys if is_variable_width(batch, k)]
    if variable and var_key_bytes is None:
        return False
    per_row_var = (var_key_bytes / batch_rows) if variable else None
    return batch_rows * key_bytes(batch, keys, per_row_var) <= limit


def merge_plan(existing: DataFrame, batch: DataFrame, keys: list[str], *,
               null_safe: bool = False, broadcast_keys: bool = False,
               distinct_keys: bool = False, key_rows: DataFrame | None = None) -> DataFrame:
    """``key_rows``: rows with the keys of the batch, where those are cheaper to compute.
    ``distinct_keys`` collapses repeated batch keys (map-side) before the join, so a key
    repeated throughout a batch that allows duplicates cannot skew the join's build
    side; the aggregate's hash partitioning is reused by the sort-merge join."""
    missing = [k for k in keys if k not in existing.columns or k not in batch.columns]
    if missing:
        raise SpecError(f"merge keys missing from target or batch: {missing}")
    right = (batch if key_rows is None else key_rows).select(
        *[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)])
    if distinct_keys:
        right = right.distinct()
    if broadcast_keys:
        right = F.broadcast(right)
    conds = [
        existing[f"`{k}`"].eqNullSafe(right[f"__k{i}"]) if null_safe else existing[f"`{k}`"] == right[f"__k{i}"]
        for i, k in enumerate(keys)
    ]
    remaining = existing.join(right, reduce(lambda a, b: a & b, conds), "left_anti")
    return remaining.unionByName(batch, allowMissingColumns=True)


def assert_unique_keys(batch: DataFrame, keys: list[str], null_safe: bool = False) -> None:
    """Raise when some key occurs twice in the batch (one shuffle of the key columns,
    combined map-side; only one offending key is brought back). Unless keys compare
    null-safely, a key with a NULL part matches nothing, so repeats of it are allowed."""
    rows = batch.select(*keys)
    if not null_safe:
        rows = rows.dropna(how="any", subset=keys)
    dup = (rows.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect())
    if dup:
        sample = {k: dup[0][k] for k in keys}
        raise DuplicateMergeKeyError(
            f"merge batch holds several rows for key {sample}; deduplicate it first "
            f"or set duplicate_keys: allow")


def _null_key(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in keys])


def _newest_first(rows: DataFrame, names: list[str], keys: list[str], version: list[str]):
    """A window over each key's rows. Equal versions are told apart by the row's content, so the
    result does not depend on the order in which rows arrive."""
    maps = {f.name for f in rows.schema.fields if isinstance(f.dataType, MapType)}
    return (Window.partitionBy(*[F.col(f"`{k}`") for k in keys])
            .orderBy(*[F.col(f"`{v}`").desc_nulls_last() for v in version], row_hash(names, maps).desc()))


def _top_version(rows: DataFrame, keys: list[str], version: list[str], null_safe: bool) -> DataFrame:
    """The row of each key with the greatest version, chosen by every task before rows are shuffled;
    rows with a null key stay, each its own, unless nulls compare equal."""
    names = rows.columns
    keyed = rows if null_safe else rows.filter(~_null_key(keys))
    best = (keyed.withColumn("__rank", F.row_number().over(_newest_first(rows, names, keys, version)))
            .filter("__rank = 1").drop("__rank"))
    return best if null_safe else best.unionByName(rows.filter(_null_key(keys)))


def _met(existing: DataFrame, batch: DataFrame, keys: list[str], version: list[str],
         null_safe: bool) -> tuple[DataFrame, list[str]]:
    """Rows of both sides whose key is not null (unless nulls compare equal), with ``__met`` (the key
    is in the batch) and ``__rank`` (1: the key's newest), by one shuffle; and the columns of both. The
    content's hash, which no codec shrinks, is computed behind the shuffle."""
    both = existing.withColumn("__new", F.lit(False)).unionByName(batch.withColumn("__new", F.lit(True)),
                                                                   allowMissingColumns=True)
    names = [c for c in both.columns if c != "__new"]
    dealt = (both if null_safe else both.filter(~_null_key(keys))).repartition(*[F.col(f"`{k}`") for k in keys])
    newest = _newest_first(both, names, keys, version)
    whole = newest.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return dealt.withColumns({"__rank": F.row_number().over(newest), "__met": F.max("__new").over(whole)}), names


def newest_rows(batch: DataFrame, keys: list[str], version: list[str], null_safe: bool = False,
                existing: DataFrame | None = None, broadcast_keys: bool = False) -> DataFrame:
    """The batch's newest row per key by the version columns (nulls oldest); with ``existing``,
    a target row of that key that is newer takes its place, so a late old row cannot overwrite a
    newer one. Target rows are met by a semi join on the batch's keys if these are broadcast, else
    in one shuffle of both sides."""
    missing = [v for v in version if v not in batch.columns]
    if missing:
        raise SpecError(f"version columns missing from batch: {missing}")
    if existing is None:
        return _top_version(batch, keys, version, null_safe)
    if not broadcast_keys:
        met, names = _met(existing, batch, keys, version, null_safe)
        best = met.filter(F.col("__met") & (F.col("__rank") == 1)).select(*[F.col(f"`{c}`") for c in names])
        return best if null_safe else best.unionByName(batch.filter(_null_key(keys)), allowMissingColumns=True)
    right = F.broadcast(batch.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]))
    conds = [existing[f"`{k}`"].eqNullSafe(right[f"__k{i}"]) if null_safe
             else existing[f"`{k}`"] == right[f"__k{i}"] for i, k in enumerate(keys)]
    held = existing.join(right, reduce(lambda a, b: a & b, conds), "left_semi")
    # a batch without a column of the target writes nulls there: both sides get the same columns,
    # in the target's order, so that equal rows have equal hashes
    both = held.unionByName(batch, allowMissingColumns=True)
    return _top_version(both, keys, version, null_safe)


def merge_by_version(existing: DataFrame, batch: DataFrame, keys: list[str], version: list[str],
                     null_safe: bool = False, broadcast_keys: bool = False) -> DataFrame:
    """Target rows whose key is not in the batch, and the newest row of every key that is (see
    ``newest_rows``). Unless the batch's keys are broadcast, a row of either side is shuffled once,
    rows with a null key not at all."""
    missing = [k for k in keys if k not in existing.columns or k not in batch.columns]
    if missing:
        raise SpecError(f"merge keys missing from target or batch: {missing}")
    if broadcast_keys:
        winners = newest_rows(batch, keys, version, null_safe, existing, broadcast_keys)
        return merge_plan(existing, winners, keys, null_safe=null_safe, broadcast_keys=True, key_rows=batch)
    met, names = _met(existing, batch, keys, version, null_safe)
    kept = met.filter(~F.col("__met") | (F.col("__rank") == 1)).select(*[F.col(f"`{c}`") for c in names])
    if null_safe:
        return kept
    alone = [side.filter(_null_key(keys)) for side in (existing, batch)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), alone, kept)


def few_keys(batch: DataFrame, keys: list[str]) -> bool:
    """Whether the keys of a batch that is kept in memory, so cheap to count, are worth a broadcast."""
    return batch.count() * key_bytes(batch, keys) <= SMALL_KEYS


def matched_partitions(existing: DataFrame, batch: DataFrame, keys: list[str], partition_columns: list[str],
                       null_safe: bool = False, broadcast_keys: bool = False) -> DataFrame:
    """Partition values of target rows whose key is in the batch (a semi join that reads
    only the key columns; partition values come from folder names)."""
    right = batch.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)])
    if broadcast_keys:
        right = F.broadcast(right)
    conds = [existing[f"`{k}`"].eqNullSafe(right[f"__k{i}"]) if null_safe
             else existing[f"`{k}`"] == right[f"__k{i}"] for i, k in enumerate(keys)]
    return (existing.select(*keys, *partition_columns)
            .join(right, reduce(lambda a, b: a & b, conds), "left_semi")
            .select(*partition_columns))


def any_key_matches(existing: DataFrame, batch: DataFrame, keys: list[str], null_safe: bool = False,
                    broadcast_keys: bool = False) -> bool:
    """Does any batch key already exist in the target? A semi join reading only the
    target's key columns; it stops at the first match."""
    right = batch.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)])
    if broadcast_keys:
        right = F.broadcast(right)
    conds = [existing[f"`{k}`"].eqNullSafe(right[f"__k{i}"]) if null_safe
             else existing[f"`{k}`"] == right[f"__k{i}"] for i, k in enumerate(keys)]
    probe = existing.select(*[F.col(f"`{k}`") for k in keys]).join(right, reduce(lambda a, b: a & b, conds),
                                                                  "left_semi")
    return len(probe.limit(1).collect()) > 0


@dataclass
class Touched:
    """Partitions an upsert rewrites: their values, the same as they appear in partition
    folder names (``cast(value as string)``), and — when the target's keys were probed —
    whether any batch key is already in the target."""
    columns: list[str]
    schema: StructType
    rows: list[tuple]
    folder_values: set
    any_match: bool | None = None

    def restrict(self, existing: DataFrame) -> DataFrame:
        """Target rows in these partitions. One ``IN`` list per column prunes the scan's
        folders at planning time; with several columns the exact combinations are then
        met by a join with the partition values (metadata, one row per partition)."""
        if not self.rows:
            return existing.filter(F.lit(False))
        for i, c in enumerate(self.columns):
            values = {r[i] for r in self.rows}
            present = sorted(v for v in values if v is not None)
            cond = F.col(f"`{c}`").isin(present) if present else F.lit(False)
            existing = existing.filter(cond | F.col(f"`{c}`").isNull() if None in values else cond)
        if len(self.columns) == 1:
            return existing
        wanted = existing.sparkSession.createDataFrame(
            self.rows, StructType([StructField(f"__p{i}", f.dataType) for i, f in enumerate(self.schema.fields)]))
        same = [existing[f"`{c}`"].eqNullSafe(wanted[f"__p{i}"]) for i, c in enumerate(self.columns)]
        return existing.join(wanted, reduce(lambda a, b: a & b, same), "left_semi")


def touched_partitions(batch: DataFrame, partition_columns: list[str], existing: DataFrame | None = None,
                       keys: list[str] | None = None, null_safe: bool = False,
                       broadcast_keys: bool = False) -> Touched:
    """The partitions an upsert must rewrite.

    With the partition columns inside the merge key these are the batch's own partitions.
    Otherwise a key may sit in (or move from) any partition, so ``existing`` and ``keys``
    are given and the partitions holding a matched key are added: a semi join of the
    target's key columns — a column-pruned scan, partition values come from folder
    names — against the batch keys. One row per partition reaches the driver, which lists
    and renames partition folders anyway."""
    probed = existing is not None and bool(keys)
    wanted = batch.select(*partition_columns).withColumn("__matched", F.lit(False))
    if probed:
        matched = matched_partitions(existing, batch, keys, partition_columns, null_safe, broadcast_keys)
        wanted = wanted.unionByName(matched.withColumn("__matched", F.lit(True)))
    text = [F.col(f"`{c}`").cast("string").alias(f"__s{i}") for i, c in enumerate(partition_columns)]
    found = (wanted.groupBy(*[F.col(f"`{c}`") for c in partition_columns]).agg(F.max("__matched").alias("__matched"))
             .select(*partition_columns, "__matched", *text).collect())
    any_match = any(r["__matched"] for r in found) if probed else None
    folders = {tuple(DEFAULT_PARTITION_NAME if r[f"__s{i}"] in (None, "") else r[f"__s{i}"]
                     for i in range(len(partition_columns))) for r in found}
    return Touched(list(partition_columns), batch.select(*partition_columns).schema,
                   [tuple(r[c] for c in partition_columns) for r in found], folders, any_match)
