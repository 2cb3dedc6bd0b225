"""Best-fit packing with Martello-Toth dominance reduction.

Only the histogram of piece lengths (at most ``capacity`` rows, whatever the corpus) comes
to the driver. There the reduction first fixes sets that provably dominate every other
way to place a length: a piece that nothing fits beside, a pair that fills a sequence, a
partner at least as long as any two that could stand in its place. What is left is placed best-fit, longest
first, whole groups of equal sequences at a time, so the work does not grow with the
number of pieces. The plan is a table of (length, range of ranks) -> sequences, a few rows
per length; Spark gives every piece its rank within its length (salted, so no length is
one task's work) and looks its place up.

Defined results: null text is empty and gives the end id alone; ties in length are ranked
by salt and row id; repeated rows are packed each; an empty table gives no rows; further
columns are ignored.
"""
from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import checkpoint, map_batches
from .word_ids import WordIds

CAPACITY = 4096
END_ID = 1
#: Rows of one length that one window group ranks, about.
RANKED_ROWS = 500_000


# ------------------------------------------------------------------ the plan (driver)

def _reduce(left: Counter, capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], Counter]:
    """Sequences fixed by dominance, as (lengths, how many), and what remains."""
    fixed: list[tuple[tuple[int, ...], int]] = []

    def take(items: tuple[int, ...], times: int) -> None:
        fixed.append((items, times))
        for length, k in Counter(items).items():
            left[length] -= k * times
            if not left[length]:
                del left[length]

    for a in sorted(left, reverse=True):
        while left[a]:
            lengths = sorted(left)
            others = [x for x in lengths if x != a or left[a] > 1]
            room = capacity - a
            fits = [x for x in others if x <= room]
            if not fits:
                take((a,), left[a])
                continue
            partner = fits[-1]
            own = 2 if partner == a else 1
            times = left[a] // 2 if own == 2 else min(left[a], left[partner])
            if partner == room:  # the pair fills the sequence: no set in the partner's place is larger
                take((a, partner), times)
                continue
            smallest = fits[0]
            free = left[smallest] - (smallest == a)
            second = smallest if free > 1 else (fits[1] if len(fits) > 1 else None)
            if second is None or smallest + second > room:
                # one piece at most fits beside a, and the largest dominates the rest;
                # times the partner: each of the pairs fixed leaves the same argument
                take((a, partner), times)
                continue
            three = list(islice((x for x in fits for _ in range(min(3, left[x] - (x == a)))), 3))
            if (len(three) < 3 or sum(three) > room) and _largest_pair(fits, left, a, room) <= partner:
                # any two that fit are no longer than the partner alone
                take((a, partner), times)
                continue
            break
    return fixed, left


def _largest_pair(fits: list[int], left: Counter, a: int, room: int) -> int:
    best, i, j = 0, 0, len(fits) - 1
    while i <= j:
        if fits[i] + fits[j] > room:
            j -= 1
        else:
            if i != j or left[fits[i]] - (fits[i] == a) > 1:
                best = max(best, fits[i] + fits[j])
            i += 1
    return best


def _best_fit(left: Counter, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over groups of equal sequences."""
    groups: dict[int, list[list]] = {}  # room -> [[lengths, how many]]
    rooms: list[int] = []
    done: list[tuple[tuple[int, ...], int]] = []

    def put(room: int, items: tuple[int, ...], times: int) -> None:
        if not times:
            return
        if not room:
            done.append((items, times))
            return
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append([items, times])

    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                items, room, have = (), capacity, -(-n // (capacity // length))
            else:
                room = rooms[at]
                items, have = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(at)
            each = room // length
            full = min(have, n // each)
            put(room - each * length, items + (length,) * each, full)
            n -= full * each
            have -= full
            if have and n and n < each:
                put(room - n * length, items + (length,) * n, 1)
                have, n = have - 1, 0
            if items:
                put(room, items, have)
    for room, some in groups.items():
        done += [(items, times) for items, times in some]
    return done


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, last rank + 1, first sequence, pieces a sequence, offset)."""
    fixed, rest = _reduce(Counter({k: v for k, v in histogram.items() if v}), capacity)
    rows, used, sequence = [], Counter(), 0
    for items, times in fixed + _best_fit(rest, capacity):
        offset = 0
        for length, each in sorted(Counter(items).items(), reverse=True):
            rows.append((length, used[length], used[length] + each * times, sequence, each, offset))
            used[length] += each * times
            offset += length * each
        sequence += times
    return rows


# ------------------------------------------------------------------ pieces and places

def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    words = WordIds(tokenizer_path)

    def cut_up(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        ids, bounds = words.encode(batch.column(1))
        row, piece, start, length, crc = [], [], [], [], []
        for i in range(len(bounds) - 1):
            own = np.append(ids[bounds[i]: bounds[i + 1]], end_id).astype("<u4")
            for k, at in enumerate(range(0, len(own), capacity)):
                part = own[at: at + capacity]
                row.append(i), piece.append(k), start.append(at), length.append(len(part))
                crc.append(zlib.crc32(part.tobytes()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
             pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
            names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_batches(docs.select(F.col(id_col).cast("bigint"), F.col(text_col)), cut_up,
                       "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length`` of 1 to ``capacity``."""
    spark = pieces.sparkSession
    kept = checkpoint(pieces)  # the tokenizer runs once
    salts = 64 + kept.count() // RANKED_ROWS
    salted = kept.withColumn("__salt", F.pmod(F.xxhash64(*pieces.columns), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "__salt").agg(F.count(F.lit(1)).alias("n"))
    # a row per length and salt: where each salt's ranks begin within its length
    begin = counts.select("length", "__salt", (F.sum("n").over(
        Window.partitionBy("length").orderBy("__salt")) - F.col("n")).alias("__begin"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = plan(histogram, capacity)
    places = spark.createDataFrame(rows, "length bigint, lo bigint, hi bigint, first bigint, each bigint, base bigint")
    order = Window.partitionBy("length", "__salt").orderBy(*[c for c in pieces.columns if c != "length"])
    ranked = (salted.withColumn("__row", F.row_number().over(order) - 1)
              .join(begin, ["length", "__salt"])
              .withColumn("__rank", F.col("__begin") + F.col("__row")))
    # a few rows per length; every length is at most the capacity
    inside = (F.col("p.length") == F.col("r.length")) & (F.col("__rank") >= F.col("lo")) & (F.col("__rank") < F.col("hi"))
    at = F.col("__rank") - F.col("lo")
    return (ranked.alias("r").join(F.broadcast(places).alias("p"), inside)
            .select(*[F.col(f"r.{c}") for c in pieces.columns],
                    (F.col("first") + F.floor(at / F.col("each"))).alias("sequence_id"),
                    (F.col("base") + (at % F.col("each")) * F.col("p.length")).alias("offset")))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    return pack(token_pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id), capacity)
