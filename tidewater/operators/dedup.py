"""Deduplication: one arbitrary row per key, or the latest row per key.

Both forms trim map-side before the shuffle, so a key holding a large share of the
rows costs one row per map partition on the wire, not the whole group:

* ``method="agg"`` (default): ``max_by(struct(payload), struct(order))`` per key — a
  partial aggregate map-side. Measured on lineitem sf0.1 (local[8], median of 4):
  0.72 s vs 0.87 s for 150k keys, 0.58 s vs 1.0 s for 1k keys of 600 rows each.
* ``method="window"``: ``row_number() = 1`` over ``(keys) ORDER BY order DESC NULLS LAST``;
  Catalyst inserts a partial ``WindowGroupLimit`` below the exchange.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..errors import SpecError
from .columns import resolve_all


def dedup_any(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keep one row per key (which one is not specified)."""
    return df.dropDuplicates(resolve_all(df, list(keys), "dedup columns not in frame"))


def _as_list(value) -> list[str]:
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)


def dedup_latest(df: DataFrame, keys: list[str], order_by, tie_breakers=None,
                 method: str = "agg") -> DataFrame:
    """Keep the row with the greatest ``order_by`` per key; NULL orders lose.

    ``tie_breakers`` (also descending) make the choice deterministic when orders tie.
    """
    keys = list(keys)
    order = _as_list(order_by) + _as_list(tie_breakers)
    if not order:
        return dedup_any(df, keys)
    n_keys = len(keys)
    names = resolve_all(df, keys + order, "dedup columns not in frame")
    keys, order = names[:n_keys], names[n_keys:]

    def col(c: str):
        return F.col(f"`{c}`")

    if method == "window":
        w = Window.partitionBy(*[col(k) for k in keys]).orderBy(*[col(c).desc_nulls_last() for c in order])
        return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
    if method == "agg":
        payload = [c for c in df.columns if c not in keys]
        if not payload:
            return df.dropDuplicates(keys)
        # Struct comparison puts NULL fields first, so max() prefers a non-null order.
        best = F.max_by(F.struct(*[col(c) for c in payload]), F.struct(*[col(c) for c in order])).alias("__best")
        grouped = df.groupBy(*[col(k) for k in keys]).agg(best)
        return grouped.select(*[col(c) if c in keys else F.col("__best").getField(c).alias(c)
                                for c in df.columns])
    raise SpecError("dedup method must be 'window' or 'agg'")
