"""Vectorised text helpers on the bytes of Arrow string columns.

A word is a maximal run of bytes other than space and \\x09-\\x0D; UTF-8 never uses those
bytes inside a longer character, so byte positions are safe. Word hashes are polynomial
sums modulo 2**64 over random byte values, then mixed.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multiplier of the rolling hash and its inverse modulo 2**64.
_R = 0x9E3779B97F4A7C15
_R_INV = pow(_R, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on a uint64 array."""
    x = x + U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: One random value per byte, from the mixer.
BYTE_VALUES = mix(np.arange(256, dtype=U64) + U64(77))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        _POWERS[:] = [np.concatenate([np.ones(1, U64), np.cumprod(np.full(size, r, U64))]) for r in (_R, _R_INV)]
    return _POWERS[0], _POWERS[1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty texts."""
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    if n == 0 or buffers[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(buffers[1], kind)[column.offset: column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document number of every word, in order."""
    inside = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)  # a word also ends where its document ends
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


class SpanHash:
    """64-bit hashes of any byte spans of one buffer."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = _powers(len(data) + 1)
        self.sums = np.empty(len(data) + 1, U64)
        self.sums[0] = 0
        np.cumsum(BYTE_VALUES[data] * power[: len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(U64))


#: Bytes whose sums are held at a time where spans are in order; each takes some 40 bytes meanwhile.
SUMMED_BYTES = 250_000


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span."""
    if len(data) <= SUMMED_BYTES or (starts[1:] < starts[:-1]).any():
        return SpanHash(data)(starts, ends)
    out, at = np.empty(len(starts), U64), 0
    while at < len(starts):
        low = starts[at]
        to = np.searchsorted(starts, low + SUMMED_BYTES)
        out[at: to] = SpanHash(data[low: ends[at: to].max()])(starts[at: to] - low, ends[at: to] - low)
        at = to
    return out


def per_doc(doc: np.ndarray, n_docs: int) -> np.ndarray:
    """First index of each document in a sorted document-number array, with the end."""
    return np.searchsorted(doc, np.arange(n_docs + 1))
