"""Sum-of-squares online packing of documents into fixed windows.

Every task packs the rows it reads as one stream: a document is placed as it comes, into the
fill level that minimises the sum, over all levels, of the squared number of windows standing
at that level. A level array holds those numbers; full windows and windows whose fill is a
power of two (which need no padding) do not count. A piece goes into any window of the
chosen level; ties go to the fullest level. Documents longer than a window give full windows
and a remainder, which is placed like a document.

Where a stream ends, or its open windows hold ``open_tokens`` tokens (the bound of a task's
memory), it is closed: documents of the emptiest windows are cut to fill up the fullest ones,
and the one window left over is cut into powers of two. So a stream pads nothing, and cuts
only documents longer than a window and about one document for each window filled up.

No row leaves its task: there is no shuffle, and a lost executor's tasks are run again on
the same input splits with the same result. Sequence numbers hold the task's number, so they
differ between tasks; one computation of the result is to be used (write it, or checkpoint).

Defined results: null text is empty and gives the end id alone; null ids are kept; repeated
rows are packed each; a text of any length is one row's ids in memory; an empty table gives no
rows; further columns, whatever their names, are ignored. Which window a row gets depends on
the order of the rows in their files, its pieces' lengths and sums do not, but for the cuts.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import cut
from .byte_ids import ByteIds

CAPACITY = 2048
END_ID = 1
#: Tokens in open windows at which a stream is closed and begun anew (4 bytes each).
OPEN_TOKENS = 8_000_000
#: Sequence numbers of one task.
PER_TASK = 1 << 36
SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")


@dataclass
class Piece:
    doc: object
    start: int
    ids: np.ndarray
    doc_tokens: int


@dataclass
class Window:
    fill: int = 0
    pieces: list[Piece] = field(default_factory=list)

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.fill += len(piece.ids)

    def take(self, wanted: int) -> Piece:
        """At most ``wanted`` tokens off the end: a whole piece if it is no longer, else its tail."""
        last = self.pieces[-1]
        if len(last.ids) <= wanted:
            self.pieces.pop()
        else:
            keep = len(last.ids) - wanted
            self.pieces[-1] = Piece(last.doc, last.start, last.ids[:keep], last.doc_tokens)
            last = Piece(last.doc, last.start + keep, last.ids[keep:], last.doc_tokens)
        self.fill -= len(last.ids)
        return last


class Stream:
    """The open windows of one task; ``place`` and ``close`` return the windows they finish."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        levels = np.arange(capacity + 1)
        self.counted = (levels & (levels - 1)) != 0  # neither empty nor a power of two
        self.counted[capacity] = False
        self.levels = np.zeros(capacity + 1, np.int64)
        #: What one more window at a level adds to the sum, and what one fewer takes off it
        #: (far below zero where there is none to take).
        self.gain = self.counted.astype(np.int64)
        self.loss = np.full(capacity + 1, np.iinfo(np.int64).min // 4)
        self.loss[0] = 0
        self.windows: dict[int, list[Window]] = {}
        self.tokens = 0

    def _count(self, level: int, change: int) -> None:
        n = self.levels[level] = self.levels[level] + change
        if self.counted[level]:
            self.gain[level], self.loss[level] = 2 * n + 1, 2 * n - 1
        elif n:
            self.loss[level] = 0
        if not n:
            self.loss[level] = np.iinfo(np.int64).min // 4

    def level_for(self, length: int) -> int:
        """The level whose windows the next piece of this length goes to (0: a new one)."""
        cost = self.gain[length:] - self.loss[: self.capacity + 1 - length]
        return len(cost) - 1 - int(np.argmin(cost[::-1]))

    def place(self, piece: Piece) -> list[Window]:
        length = len(piece.ids)
        level = self.level_for(length)
        if level:
            window = self.windows[level].pop()
            self._count(level, -1)
        else:
            window = Window()
        window.add(piece)
        self.tokens += length
        if window.fill == self.capacity:
            self.tokens -= self.capacity
            return [window]
        self.windows.setdefault(window.fill, []).append(window)
        self._count(window.fill, 1)
        return []

    def close(self) -> list[Window]:
        """All open windows, none of which needs padding afterwards."""
        done = [w for level, some in self.windows.items() if not self.counted[level] for w in some]
        part = sorted((w for level, some in self.windows.items() if self.counted[level] for w in some),
                      key=lambda w: -w.fill)
        at, last = 0, len(part) - 1
        while at < last:
            room = self.capacity - part[at].fill
            if not room:
                at += 1
                continue
            part[at].add(part[last].take(room))
            if not part[last].fill:
                last -= 1
        done += part[:last]
        if last >= 0:
            left, bit = part[last], self.capacity
            while bit:
                if left.fill >= bit and (left.fill & bit or bit == self.capacity):
                    own = Window()
                    while own.fill < bit:
                        own.add(left.take(bit - own.fill))
                    done.append(own)
                bit >>= 1
            if left.fill:  # the capacity is no power of two
                done.append(left)
        self.__init__(self.capacity)
        return done


def _rows(windows: list[tuple[int, Window]], id_type: pa.DataType) -> pa.RecordBatch:
    cols: list[list] = [[] for _ in range(7)]
    for number, w in windows:
        offset = 0
        for p in w.pieces:
            for col, value in zip(cols, (p.doc, p.start, len(p.ids), zlib.crc32(p.ids), p.doc_tokens, number, offset),
                                  strict=True):
                col.append(value)
            offset += len(p.ids)
    return pa.RecordBatch.from_arrays([pa.array(c, id_type if i == 0 else pa.int64()) for i, c in enumerate(cols)],
                                      names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                                             "offset"])


def _streams(batches: Iterator[pa.RecordBatch], ids_of: ByteIds, capacity: int, end_id: int, open_tokens: int,
             base: int) -> Iterator[pa.RecordBatch]:
    stream, n = Stream(capacity), base
    for whole in batches:
        for batch in cut(whole):
            finished: list[Window] = []
            ids, bounds = ids_of.encode(batch.column(1))
            for i, doc in enumerate(batch.column(0).to_pylist()):
                own = np.append(ids[bounds[i]: bounds[i + 1]], end_id).astype("<u4")
                rest = len(own) - len(own) % capacity
                for at in range(0, rest, capacity):
                    full = Window()
                    full.add(Piece(doc, at, own[at: at + capacity], len(own)))
                    finished.append(full)
                if rest < len(own):
                    # a copy, so that an open window holds its own tokens only
                    finished += stream.place(Piece(doc, rest, own[rest:].copy() if rest else own, len(own)))
                if stream.tokens >= open_tokens:
                    finished += stream.close()
            if finished:
                yield _rows(list(enumerate(finished, n)), pa.int64())
                n += len(finished)
    if finished := stream.close():
        yield _rows(list(enumerate(finished, n)), pa.int64())


def pack_online(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY, end_id: int = END_ID, open_tokens: int = OPEN_TOKENS) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    ids_of = ByteIds(tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _streams(batches, ids_of, capacity, end_id, open_tokens, TaskContext.get().partitionId() * PER_TASK)

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(run, SCHEMA)
