"""Byte-level BPE ids of whole texts, encoding each distinct part once per worker.

The tokenizer's own pattern never joins a character that is no white space to white space
after it, so a text may be cut in front of every ASCII white space that follows something
else: each unit is a run of white space and the word behind it, and a text's ids are its
units' ids in order. Units behind a character that may be white space beyond ASCII are not
cut off. In a unit of one white space or none, Latin letters and a tail of marks, the letters
(with a space in front), the tail and other white space are pre-tokens of their own, and it
is cut there. Only parts the worker has not met go through the tokenizer.
"""
from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from ._text import IS_SPACE, text_bytes
from .word_ids import MEMORY, _Memory, letters_end

#: Third and second last bytes of white space beyond ASCII (U+1680, U+2000 to U+205F, U+3000),
#: whatever comes last, and the two-byte ones (U+0085, U+00A0).
_WIDE, _WIDE2 = (0xE1, 0xE2, 0xE3), (0x9A, 0x80, 0x81)
_NARROW = (0x85, 0xA0)


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where units begin: at each text and at each white space behind something else."""
    n = len(data)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    if n:
        space = IS_SPACE[data]
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[0] = False
        if n > 2:
            wide = np.isin(data[:-2], _WIDE) & np.isin(data[1:-1], _WIDE2)
            cut[3:] &= ~wide[:-1]
        if n > 1:
            narrow = (data[:-1] == 0xC2) & np.isin(data[1:], _NARROW)
            cut[2:] &= ~narrow[:-1]
        first[:-1] |= cut
    return np.flatnonzero(first[:-1])


class ByteIds:
    """Ids as the tokenizer file gives them to whole texts, without special tokens added."""

    def __init__(self, path: str, memory: int = MEMORY):
        self.path, self.memory = path, memory

    def _worker(self) -> "_Units":
        if self.path not in _WORKER:
            _WORKER[self.path] = _Units(self.path)
        found = _WORKER[self.path]
        if len(found.known) > self.memory:
            found.forget()
        return found

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's begin, with the end)."""
        data, offsets = text_bytes(column)
        starts = unit_starts(data, offsets)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        space = IS_SPACE[data[starts]]
        stop, plain = letters_end(data, ends, starts + space)
        stop = np.where(plain, stop, ends)
        blank = data[starts] == 32
        lead = starts + (plain & space & ~blank)
        letters = plain & blank
        starts, ends = np.stack([starts, lead, stop], axis=1).ravel(), np.stack([lead, stop, ends], axis=1).ravel()
        none = np.zeros_like(letters)
        letters = np.stack([none, letters, none], axis=1).ravel()
        some = ends > starts
        return self._worker().encode(data, starts[some], ends[some], letters[some], offsets)


_WORKER: dict[str, "_Units"] = {}


class _Units(_Memory):
    """Ids of the parts met so far; ``single`` parts have a space in front."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        for piece, i in vocabulary.items():
            self.spaced[i] = piece.startswith("Ġ")  # the vocabulary's sign for a space
        self.forget()

    def _together(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """Cut where the next one's space begins."""
        ids = np.array(self._encoded([b"".join(parts)])[0], np.int32)
        first = np.flatnonzero(self.spaced[ids])
        return (ids, np.diff(first, append=len(ids))) if len(first) == len(parts) else None
