"""Transforms named in a spec, compiled to ``DataFrame -> DataFrame`` functions and
applied in order with ``DataFrame.transform``."""
from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

from ..errors import SpecError
from ..spec import TransformSpec
from .columns import add_metadata, cast_columns, drop_columns, rename_columns
from .dedup import dedup_any, dedup_latest

TransformFn = Callable[[DataFrame], DataFrame]

# Transforms whose plan contains a shuffle; a batch with one of these is persisted
# before the quality profile so the shuffle runs once.
WIDE_TRANSFORMS = {"deduplicate"}

_CUSTOM: dict[str, Callable[..., TransformFn]] = {}


def register_transform(kind: str, factory: Callable[..., TransformFn], wide: bool = True) -> None:
    """Add a transform type: ``factory(**params) -> (DataFrame -> DataFrame)``."""
    _CUSTOM[kind.lower()] = factory
    if wide:
        WIDE_TRANSFORMS.add(kind.lower())


# Parameters each built-in transform needs.
REQUIRED_PARAMS = {"rename": ("mapping",), "cast": ("columns",), "drop": ("columns",),
                   "deduplicate": ("keys",), "add_metadata": ()}


def compile_transform(t: TransformSpec, dataset_name: str, run_time: _dt.datetime) -> TransformFn:
    p = t.params
    kind = t.type
    missing = [k for k in REQUIRED_PARAMS.get(kind, ()) if k not in p]
    if missing:
        raise SpecError(f"transform {kind!r} needs {missing}")
    if kind == "rename":
        return lambda df: rename_columns(df, p["mapping"])
    if kind == "cast":
        return lambda df: cast_columns(df, p["columns"], p.get("on_error", "null"))
    if kind == "add_metadata":
        name = p.get("dataset_name", dataset_name)
        return lambda df: add_metadata(df, name, run_time)
    if kind == "drop":
        return lambda df: drop_columns(df, p["columns"])
    if kind == "deduplicate":
        keys = p["keys"]
        if p.get("order_by"):
            return lambda df: dedup_latest(df, keys, p["order_by"], p.get("tie_breakers"),
                                           p.get("method", "agg"))
        return lambda df: dedup_any(df, keys)
    if kind in _CUSTOM:
        return _CUSTOM[kind](**p)
    raise SpecError(f"Unknown transform type: {kind}")


def apply_chain(df: DataFrame, fns: list[TransformFn]) -> DataFrame:
    return reduce(lambda acc, fn: acc.transform(fn), fns, df)


def compile_chain(transforms: list[TransformSpec], dataset_name: str,
                  run_time: _dt.datetime) -> list[TransformFn]:
    return [compile_transform(t, dataset_name, run_time) for t in transforms]


def is_wide(transforms: list[TransformSpec]) -> bool:
    return any(t.type in WIDE_TRANSFORMS for t in transforms)
