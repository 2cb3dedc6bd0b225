"""Token ids of whole texts, encoding each distinct part of a word once per worker.

For a tokenizer that drops white space and never joins words across it: a text's ids are
its words' ids in order. A word of Latin letters with a tail of marks is two pre-tokens
and is cut there, so words that differ in their tail or in capitals share their parts. Parts
are found, hashed and looked up with array operations; only those the worker has not met go
through the tokenizer.
"""
from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from ._text import LOWER, U64, span_hashes, text_bytes, word_spans

#: Parts kept per worker; beyond it the memory starts afresh, which costs time only.
MEMORY = 1_000_000
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: ASCII marks but the apostrophe, which contractions begin with.
_MARK = np.zeros(256, bool)
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True
_MARK[39] = False


def letters_end(data: np.ndarray, ends: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where the Latin letters from ``lead`` on end, whether there are some and only marks are behind them)."""
    letter = _LETTER[data]
    latin = np.flatnonzero(data[:-1] == 0xC3)  # U+00C0 to U+00FF but the signs for times and division
    latin = latin[(data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7)]
    letter[latin] = letter[latin + 1] = True
    other = np.append(np.flatnonzero(~letter), len(data))
    stop = np.minimum(other[np.searchsorted(other, lead)], ends)
    strange = np.concatenate([[0], np.cumsum(~_MARK[data])])
    return stop, (stop > lead) & (strange[ends] == strange[stop])


class WordIds:
    def __init__(self, path: str, memory: int = MEMORY):
        self.path, self.memory = path, memory

    def __getstate__(self):
        return {"path": self.path, "memory": self.memory}

    def __setstate__(self, state):
        self.__init__(**state)

    def _worker(self) -> "_Memory":
        if (self.path, self.memory) not in _WORKER:
            _WORKER[self.path, self.memory] = _Memory(self.path)
        found = _WORKER[self.path, self.memory]
        if len(found.known) > self.memory:
            found.forget()
        return found

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's begin, with the end)."""
        data, offsets = text_bytes(column)
        starts, ends, _ = word_spans(data, offsets)
        stop, plain = letters_end(data, ends, starts)
        stop = np.where(plain, stop, ends)
        inside = np.zeros(len(data) + 1, np.int8)  # capitals count for nothing in plain words
        inside[starts[plain]] += 1
        inside[stop[plain]] -= 1
        data = np.where(np.cumsum(inside[:-1], dtype=np.int8).view(bool), LOWER[data], data)
        starts, ends = np.stack([starts, stop], axis=1).ravel(), np.stack([stop, ends], axis=1).ravel()
        letters = np.stack([plain, np.zeros_like(plain)], axis=1).ravel()
        some = ends > starts
        return self._worker().encode(data, starts[some], ends[some], letters[some], offsets)


_WORKER: dict[tuple, "_Memory"] = {}


class _Memory:
    """Ids of the parts met so far, in one pool."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for piece, i in vocabulary.items():
            self.ends[i] = piece.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        self.known, self.at = np.zeros(0, U64), np.zeros(0, np.int64)  # sorted hashes, their entries
        self.pool, self.used = np.zeros(1 << 16, np.int32), 0
        self.begin, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, single: np.ndarray,
               offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these parts of texts in a row, where each text's begin, with the end;
        ``single``: parts that are letters only, hence one pre-token."""
        keys, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        entry = self._entries(keys, data, starts[first], ends[first], single[first])
        begin, length = self.begin[entry][inverse], self.length[entry][inverse]
        total = np.concatenate([[0], np.cumsum(length)])
        ids = self.pool[np.repeat(begin - total[:-1], length) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, offsets)]

    def _entries(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                 single: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.known, keys)
        found = np.zeros(len(keys), bool)
        if len(self.known):
            found = self.known[np.minimum(place, len(self.known) - 1)] == keys
        out = np.zeros(len(keys), np.int64)
        out[found] = self.at[place[found]]
        raw = data.tobytes()
        for several in (True, False):
            new = np.flatnonzero(~found & (single == several))
            parts = [raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
            out[new] = len(self.begin) + np.arange(len(new))
            self._learn(parts, several)
        new = np.flatnonzero(~found)
        self.known = np.insert(self.known, place[new], keys[new])
        self.at = np.insert(self.at, place[new], out[new])
        return out

    def _learn(self, parts: list[bytes], several: bool) -> None:
        for k in range(0, len(parts), 2000):
            some = parts[k: k + 2000]
            self._add(*((several and self._together(some)) or self._each(some)))

    def _together(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids, how many each part has) of parts encoded in one call; each ends with its own end piece."""
        ids = np.array(self._encoded([b" ".join(parts)])[0], np.int32)
        last = np.flatnonzero(self.ends[ids]) + 1
        # else one of them is more than a pre-token
        return (ids, np.diff(last, prepend=0)) if len(last) == len(parts) else None

    def _each(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = self._encoded(parts)
        return np.fromiter(chain.from_iterable(ids), np.int32), np.array([len(x) for x in ids], np.int64)

    def _encoded(self, parts: list[bytes]) -> list[list[int]]:
        texts = [p.decode("utf-8", "replace") for p in parts]
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, ids: np.ndarray, length: np.ndarray) -> None:
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used: self.used + len(ids)] = ids
        self.begin = np.concatenate([self.begin, self.used + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.used += len(ids)
