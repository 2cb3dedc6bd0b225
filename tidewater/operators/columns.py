"""Column transforms. Each is one projection over the input (no per-column plan nodes)."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import SpecError

# Names of the metadata columns added at ingestion.
INGESTED_AT = "_ingested_at"
DATASET_NAME = "_dataset_name"


def resolve(df: DataFrame, name: str) -> str | None:
    """The frame's own spelling of a column, found as the session compares names
    (``spark.sql.caseSensitive``); None if there is none."""
    if name in df.columns:
        return name
    if df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true":
        return None
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def resolve_all(df: DataFrame, names: list[str], what: str) -> list[str]:
    """``resolve`` for columns that must be there."""
    found = [resolve(df, n) for n in names]
    missing = [n for n, f in zip(names, found, strict=True) if f is None]
    if missing:
        raise SpecError(f"{what}: {missing}")
    return found


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename all at once (``{a: b, b: a}`` swaps); names not in ``df`` are ignored."""
    present = {found: new for old, new in mapping.items() if (found := resolve(df, old))}
    out_names = [present.get(c, c) for c in df.columns]
    dupes = {n for n in out_names if out_names.count(n) > 1}
    if dupes:
        raise SpecError(f"rename would produce duplicate columns: {sorted(dupes)}")
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, out_names)])


def cast_columns(df: DataFrame, casts: dict[str, str], on_error: str = "null") -> DataFrame:
    """Cast in place, keeping column order. ``on_error="null"`` turns values that do not
    convert into NULL (``try_cast``); ``"fail"`` raises, as ANSI ``cast`` does. Casting a
    column that does not exist is an error."""
    names = resolve_all(df, list(casts), "cannot cast missing columns")
    casts = dict(zip(names, casts.values(), strict=True))
    if on_error not in ("null", "fail"):
        raise SpecError("on_error must be 'null' or 'fail'")
    return df.withColumns({
        c: (F.col(f"`{c}`").try_cast(t) if on_error == "null" else F.col(f"`{c}`").cast(t))
        for c, t in casts.items()
    })


def add_metadata(df: DataFrame, dataset_name: str, ingested_at: _dt.datetime | None = None) -> DataFrame:
    """Add ``_ingested_at`` and ``_dataset_name``.

    The timestamp is a literal fixed once per run (UTC), so every action, target and
    recomputed partition of the batch carries the same value.
    """
    when = ingested_at or _dt.datetime.now(_dt.timezone.utc)
    return df.withColumns({INGESTED_AT: F.lit(when).cast("timestamp"), DATASET_NAME: F.lit(dataset_name)})


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop the named columns; names not in ``df`` are ignored."""
    return df.drop(*columns)
