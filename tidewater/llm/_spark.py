"""Small Spark helpers shared by the operators."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder named by ``spark.checkpoint.dir``."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(work_dir(spark))
    return df.checkpoint(eager=True)


def fenced(value: Column) -> Column:
    """The same value, which the optimizer does not copy into filters and array functions,
    where it would be evaluated once for each element."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1; a null id counts as not held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str,
                limit: int = 2_000_000) -> DataFrame:
    """mapInArrow over batches cut to a few megabytes of text each, or to ``limit`` bytes."""
    def run(batches):
        for batch in batches:
            for part in cut(batch, limit):
                yield from fn(part)
    return df.mapInArrow(run, schema)


def cut(batch: pa.RecordBatch, limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes each; one longer row stays whole."""
    n = batch.num_rows
    if n and batch.nbytes > limit:
        import numpy as np

        sizes = np.zeros(n, np.int64)
        for col in batch.columns:
            if pa.types.is_string(col.type) or pa.types.is_binary(col.type):
                off = np.frombuffer(col.buffers()[1], np.int32)[col.offset: col.offset + n + 1]
                sizes += np.diff(off)
        total = np.cumsum(sizes)
        start = 0
        while start < n:
            stop = int(np.searchsorted(total, (total[start - 1] if start else 0) + limit, "right"))
            stop = min(max(stop, start + 1), n)
            yield batch.slice(start, stop - start)
            start = stop
    else:
        yield batch
