"""Exact deduplication by Grace hashing.

Map side, each task folds its rows into one record per distinct content, so a group of
copies sends at most one record per task. The records are dealt by content hash; each
bucket is read as a stream and, while it is too large for its table, split again by
further hash bits into spill files. A bucket that fits goes into an open-addressing table
whose probes compare the complete content. Winners come back to the rows by SHA-256, length
and id, never by where a row was read: two scans of one table may split it differently.

Spill files belong to one task, live in a folder removed with it, and are written anew
when the task is retried; nothing else reads them.

Defined results: null text is empty text, and all texts without content are one group;
ties in length go to the smallest id (a null id last); of rows repeated under one id one
row stays; further columns are ignored by ``exact_groups`` and kept by ``drop_copies``.
Two contents with one SHA-256 raise an error.
"""
from __future__ import annotations

import hashlib
import os
import pickle
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from ._spark import cut

#: The white space taken out before texts are compared.
SPACES = b" \t\n\x0b\x0c\r"
#: Content bytes one table may hold before its bucket is split again.
TABLE_BYTES = 48_000_000
FANOUT = 16


class ContentTable:
    """Open addressing with linear probing; a hit needs equal complete content."""

    def __init__(self, slots: int = 1 << 10):
        self.slots: list[int] = [-1] * slots
        self.digests: list[bytes] = []
        self.contents: list[bytes] = []
        self.values: list[list] = []
        self.bytes = 0

    def entry(self, digest: bytes, content: bytes) -> list:
        """The value list kept for this content, new (empty) if it was not there."""
        if 2 * len(self.values) >= len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            for i, d in enumerate(self.digests):
                self.slots[self._free(d)] = i
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[8:16], "little") & mask
        while (i := self.slots[at]) >= 0:
            if self.digests[i] == digest:
                if self.contents[i] != content:
                    raise ValueError(f"two contents with SHA-256 {digest.hex()}")
                return self.values[i]
            at = (at + 1) & mask
        self.slots[at] = len(self.values)
        self.digests.append(digest)
        self.contents.append(content)
        self.values.append([])
        self.bytes += len(content)
        return self.values[-1]

    def _free(self, digest: bytes) -> int:
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[8:16], "little") & mask
        while self.slots[at] >= 0:
            at = (at + 1) & mask
        return at


def _content(text: str | None) -> bytes:
    return (text or "").encode("utf-8").translate(None, SPACES)


def _rank(chars: int, key: int | None) -> tuple[int, bool, int]:
    """The least rank stays: longest first, then ids, then no id."""
    return -chars, key is None, key or 0


def _id(rank: tuple[int, bool, int]) -> int | None:
    return None if rank[1] else rank[2]


def _fold(value: list, count: int, rank: tuple) -> None:
    """value: [count, best rank]."""
    if value:
        value[0] += count
        value[1] = min(value[1], rank)
    else:
        value += [count, rank]


_RECORD = "digest binary, content binary, n bigint, n_chars bigint, id bigint"


def _map_side(batches):
    """(id, text) rows to one record per distinct content and table filling."""
    table = ContentTable()
    for batch in batches:
        for part in cut(batch):
            for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                content = _content(text)
                _fold(table.entry(hashlib.sha256(content).digest(), content), 1, _rank(len(text or ""), key))
            if table.bytes > TABLE_BYTES // 2 or len(table.values) > 200_000:
                yield from _records(table)
                table = ContentTable()
    yield from _records(table)


def _records(table: ContentTable, step: int = 2_000_000):
    start, size = 0, 0
    for i in range(len(table.values) + 1):
        if i == len(table.values) or size > step:
            if i > start:
                v = table.values[start:i]
                yield pa.RecordBatch.from_arrays([
                    pa.array(table.digests[start:i], pa.binary()), pa.array(table.contents[start:i], pa.binary()),
                    pa.array([x[0] for x in v], pa.int64()), pa.array([-x[1][0] for x in v], pa.int64()),
                    pa.array([_id(x[1]) for x in v], pa.int64())],
                    names=["digest", "content", "n", "n_chars", "id"])
            start, size = i, 0
        if i < len(table.values):
            size += len(table.contents[i]) + 64


def _resolve(records, level: int, limit: int):
    """Tables of distinct contents: one if everything fits, else one per spilled part."""
    table, parts, folder = ContentTable(), None, None
    try:
        for digest, content, n, rank in records:
            if parts is None:
                _fold(table.entry(digest, content), n, rank)
                if table.bytes > limit and level < 16:
                    folder = tempfile.TemporaryDirectory(prefix="grace-")
                    parts = [open(os.path.join(folder.name, str(k)), "wb") for k in range(FANOUT)]
                    for d, c, v in zip(table.digests, table.contents, table.values, strict=True):
                        pickle.dump((d, c, v[0], v[1]), parts[_part(d, level)])
                    table = ContentTable()
            else:
                pickle.dump((digest, content, n, rank), parts[_part(digest, level)])
        if parts is None:
            yield table
            return
        for part in parts:
            part.close()
            yield from _resolve(_spilled(part.name), level + 1, limit)
            os.unlink(part.name)
    finally:
        for part in parts or []:
            part.close()
        if folder:
            folder.cleanup()


def _part(digest: bytes, level: int) -> int:
    return (digest[16 + level // 2] >> (4 * (level % 2))) & (FANOUT - 1)


def _spilled(path: str):
    with open(path, "rb") as f:
        while True:
            try:
                yield pickle.load(f)
            except EOFError:
                return


def _bucket_side(limit: int, names: tuple = ("text_sha256", "keep_id", "group_size", "keep_chars")):
    def run(batches):
        def records():
            for batch in batches:
                for part in cut(batch):
                    for d, c, n, chars, key in zip(*(col.to_pylist() for col in part.columns), strict=True):
                        yield d, c, n, _rank(chars, key)
        for table in _resolve(records(), 0, limit):
            v = table.values
            for i in range(0, len(v), 20_000):
                some = v[i: i + 20_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([d.hex() for d in table.digests[i: i + 20_000]]),
                    pa.array([_id(x[1]) for x in some], pa.int64()),
                    pa.array([x[0] for x in some], pa.int64()), pa.array([-x[1][0] for x in some], pa.int64())],
                    names=list(names))
    return run


def _digests(batches):
    """(id, text) rows to (id, digest, length)."""
    for batch in batches:
        for part in cut(batch):
            texts = part.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array([hashlib.sha256(_content(t)).hexdigest() for t in texts], pa.string()),
                pa.array([len(t or "") for t in texts], pa.int64())], names=["doc_id", "text_sha256", "chars"])


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    # dealt by content: no key of a record is shared by more than one record per map task
    dealt = rows.mapInArrow(_map_side, _RECORD).repartition("digest")
    winners = dealt.mapInArrow(
        _bucket_side(table_bytes), "text_sha256 string, keep_id bigint, group_size bigint, keep_chars bigint")
    # rows repeated under one id are alike in all that is returned: counted, then one of them stays
    each = (rows.mapInArrow(_digests, "doc_id bigint, text_sha256 string, chars bigint")
            .groupBy("doc_id", "text_sha256", "chars").agg(F.count(F.lit(1)).alias("__times")))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    return (each.join(winners.hint("merge"), "text_sha256")
            .select("*", F.explode(F.sequence(F.lit(1), F.col("__times"))).alias("__time"))
            .select("doc_id", "keep_id", "group_size",
                    (stays & (F.col("__time") == 1)).alias("kept"), "text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    names = docs.columns
    won = F.concat_ws(":", "__sha", F.col("__chars").cast("string"), F.coalesce(F.col("__id").cast("string"), F.lit("none")))

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    winners = (rows.mapInArrow(_map_side, _RECORD).repartition("digest").mapInArrow(
        _bucket_side(table_bytes, ("__sha", "__id", "group_size", "__chars")),
        "__sha string, __id bigint, group_size bigint, __chars bigint").drop("group_size"))

    def digests(batches):
        for batch in (part for whole in batches for part in cut(whole)):
            texts = batch.column(names.index(text_col)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([hashlib.sha256(_content(t)).hexdigest() for t in texts], pa.string()),
                 pa.array([len(t or "") for t in texts], pa.int64())], names=[*names, "__sha", "__chars"])

    schema = StructType([*docs.schema.fields]).add("__sha", StringType()).add("__chars", LongType())
    each = docs.mapInArrow(digests, schema).withColumn("__id", F.col(id_col).cast("bigint"))
    # one column names content, length and id, so what the join has dealt out need not be dealt again to
    # choose one of the rows repeated under the winner's id
    stay = each.withColumn("__won", won).join(winners.select(won.alias("__won")).hint("merge"), "__won", "left_semi")
    return stay.dropDuplicates(["__won"]).select(*names)
