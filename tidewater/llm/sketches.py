"""Fixed-size arrays gathered from all rows: a counting sketch and a Bloom filter.

Each task fills one array and sends its blocks compressed; blocks are added up where they
meet. The driver gets one array of a size that is a parameter, not a share of the data.
"""
from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._spark import cut

BLOCKS = 64


def _sent(values: np.ndarray) -> pa.RecordBatch:
    step = len(values) // BLOCKS
    parts = [(i, zlib.compress(values[i * step: (i + 1) * step].tobytes(), 1)) for i in range(BLOCKS)
             if values[i * step: (i + 1) * step].any()]
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int32()),
                                       pa.array([p[1] for p in parts], pa.binary())], names=["block", "part"])


def gather(rows: DataFrame, size: int, dtype: str, fill: Callable[[np.ndarray, pa.RecordBatch], None],
           merge: Callable[[np.ndarray, np.ndarray], np.ndarray], out_dtype: str | None = None,
           finish: Callable[[np.ndarray], np.ndarray] | None = None) -> np.ndarray:
    """An array of ``size`` values: ``fill`` adds a batch to a task's array, ``merge`` joins two."""
    if size % BLOCKS:
        raise ValueError(f"size must be a multiple of {BLOCKS}")

    def local(batches) -> Iterator[pa.RecordBatch]:
        values = None
        for whole in batches:
            for batch in cut(whole):
                if values is None:
                    values = np.zeros(size, dtype)
                fill(values, batch)
        if values is not None:
            yield _sent(values)

    def joined(batches) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = np.frombuffer(zlib.decompress(part.as_py()), dtype)
                blocks[block] = merge(blocks[block], values) if block in blocks else values
        if blocks:
            done = {k: (finish(v) if finish else v) for k, v in blocks.items()}
            yield pa.RecordBatch.from_arrays([pa.array(list(done), pa.int32()),
                                              pa.array([zlib.compress(v.tobytes(), 1) for v in done.values()], pa.binary())],
                                             names=["block", "part"])

    kind = "block int, part binary"
    out = np.zeros(size, out_dtype or dtype)
    step = size // BLOCKS
    for r in rows.mapInArrow(local, kind).repartition("block").mapInArrow(joined, kind).collect():
        out[r["block"] * step: (r["block"] + 1) * step] = np.frombuffer(zlib.decompress(r["part"]), out.dtype)
    return out
