"""Quality rules: line-first cleaning.

Every line of a text is judged on its own by rules for punctuation, navigation and
boilerplate. Failing lines are removed; a document that loses too much of its text, or
fails the base rules, is rejected. Per-document work only, so one narrow pass without a
shuffle; a long document is one row and costs memory in proportion to its own length.

Defined results: null text counts as empty; a text without words fails the base rules and
is rejected; repeated rows are judged each; further columns, whatever their names, are
passed through by ``clean_documents`` and ignored by ``judge_documents``.
"""
from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import map_batches
from ._text import LOWER, U64, mix, per_doc, span_hashes, text_bytes, word_spans

#: The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
#: Phrases that mark a line as boilerplate, in lower case.
BOILERPLATE = ("lorem ipsum", "all rights reserved", "terms of use", "terms of service", "privacy policy",
               "cookie policy", "use of cookies", "enable javascript", "click here", "read more", "sign up",
               "subscribe to our", "log in", "share this", "follow us", "back to top", "licensed under")


@dataclass(frozen=True)
class LineRules:
    """Thresholds. Shares are of a line's words, or of a document's word characters."""

    symbol_words: float = 0.5   # punctuation: share of words ending in a symbol run
    shouting_words: float = 0.8  # punctuation: share of the cased words wholly in capitals
    min_shouting: int = 8       # ... among so many words at least
    nav_separators: float = 0.3  # navigation: share of words that are bare separators
    min_nav: int = 6            # ... among so many words at least
    phrase_words: float = 0.2   # boilerplate: share of words that belong to phrases
    max_phrase_line: int = 20   # ... or one phrase in a line of so many words at most
    max_lost: float = 0.4       # a document that loses more of its word characters is rejected
    phrases: tuple[str, ...] = field(default=BOILERPLATE)


_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_SEPARATOR = np.zeros(256, bool)
_IS_SEPARATOR[list(b"|>/-*")] = True

_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[ends] - total[starts]


def analyse(column: pa.Array, rules: LineRules = LineRules()) -> dict[str, np.ndarray]:
    """Counts per document and, per line, its span and whether it stays."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    starts, ends, doc = word_spans(data, offsets)
    first = per_doc(doc, n)
    n_words = np.diff(first)
    code_points = _sums((data & 0xC0) != 0x80, starts, ends)
    word_chars = _sums(code_points, first[:-1], first[1:])
    n_symbols = _sums(_IS_SYMBOL[data], offsets[:-1], offsets[1:])

    # lines: from a document's start or behind a \n up to the next \n or the document's end
    breaks = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], breaks + 1])).astype(np.int64)
    line_start = line_start[line_start < len(data)]
    line_doc = np.searchsorted(offsets, line_start, "right") - 1
    next_start = np.append(line_start[1:], len(data)) if len(line_start) else line_start
    line_end = np.minimum(next_start, offsets[line_doc + 1]) if len(line_start) else line_start
    if len(line_start):
        line_end = line_end - ((line_end > line_start) & (data[np.maximum(line_end - 1, 0)] == 10))
    w0, w1 = np.searchsorted(starts, line_start), np.searchsorted(starts, line_end)
    line_words = w1 - w0

    # duplicate lines: equal to an earlier one of the document
    lines = np.flatnonzero(line_words > 0)
    key = span_hashes(data, line_start[lines], line_end[lines]) ^ mix(line_doc[lines].astype(U64))
    dup = np.zeros(len(lines), bool)
    if len(lines):
        _, at = np.unique(key, return_index=True)
        dup[:] = True
        dup[at] = False
    n_dup_lines = np.bincount(line_doc[lines[dup]], minlength=n) if n else np.zeros(0, np.int64)

    # words inside 3-word windows that are found twice or more
    repeated = np.zeros(len(starts), bool)
    if len(starts) >= 3:
        h = span_hashes(data, starts, ends)
        with np.errstate(over="ignore"):
            tri = mix(h[:-2] * U64(0x9FB21C651E98DF25) + h[1:-1] * U64(0xD6E8FEB86659FD93) + h[2:])
        whole = np.flatnonzero(doc[:-2] == doc[2:])
        _, inverse, counts = np.unique(tri[whole] ^ mix(doc[whole].astype(U64)), return_inverse=True, return_counts=True)
        again = whole[counts[inverse] >= 2]
        for k in range(3):
            repeated[again + k] = True
    n_repeat = _sums(repeated, first[:-1], first[1:])

    # line rules, as shares of the line's words
    last = data[ends - 1] if len(ends) else data[:0]
    symbolic = _IS_SYMBOL[last] & (ends - starts > 1)
    bare = _IS_SEPARATOR[last] & (ends - starts == 1)
    upper = _sums((data >= 65) & (data <= 90), starts, ends)
    lower = _sums((data >= 97) & (data <= 122), starts, ends)
    cased, loud = (upper + lower) > 1, ((upper > 1) & (lower == 0))
    share = np.maximum(line_words, 1)
    cased_words = _sums(cased, w0, w1)
    punctuation = (_sums(symbolic, w0, w1) > rules.symbol_words * share) | (
        (cased_words >= rules.min_shouting) & (_sums(loud, w0, w1) > rules.shouting_words * cased_words))
    navigation = (line_words >= rules.min_nav) & (_sums(bare, w0, w1) > rules.nav_separators * share)
    in_phrase = np.zeros(len(starts), bool)
    lowered = LOWER[data].tobytes()
    for phrase in rules.phrases:
        text, at = phrase.encode(), -1
        while (at := lowered.find(text, at + 1)) >= 0:
            line = np.searchsorted(line_start, at, "right") - 1
            if (at + len(text) <= line_end[line] and (at == line_start[line] or not _IN_WORD[data[at - 1]])
                    and (at + len(text) == line_end[line] or not _IN_WORD[data[at + len(text)]])):
                in_phrase[np.searchsorted(starts, at, "right") - 1: np.searchsorted(starts, at + len(text))] = True
    phrase_words = _sums(in_phrase, w0, w1)
    boilerplate = (phrase_words > 0) & ((line_words <= rules.max_phrase_line) | (phrase_words > rules.phrase_words * share))
    duplicate = np.zeros(len(line_start), bool)
    duplicate[lines[dup]] = True
    failed = (line_words > 0) & (punctuation | navigation | boilerplate | duplicate)
    lost = np.zeros(n, np.int64)
    np.add.at(lost, line_doc[failed], _sums(code_points, w0, w1)[failed])
    base_failed = (n_words < 50) | (100 * n_repeat > 50 * n_words)
    kept = ~base_failed & (lost <= rules.max_lost * word_chars)
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines,
            "n_repeat_words": n_repeat, "base_failed": base_failed, "kept": kept, "lost_chars": lost,
            "n_failed_lines": np.bincount(line_doc[failed], minlength=n) if n else lost,
            "_data": data, "_line_start": line_start, "_line_end": line_end, "_line_doc": line_doc, "_failed": failed}


def clean_texts(seen: dict[str, np.ndarray], rows: np.ndarray) -> list[str | None]:
    """The texts of these rows without their failed lines; None: nothing was removed."""
    data = seen["_data"].tobytes()
    changed = np.zeros(len(seen["kept"]), bool)
    changed[seen["_line_doc"][seen["_failed"]]] = True
    first = per_doc(seen["_line_doc"], len(seen["kept"]))
    out: list[str | None] = []
    for row in rows:
        if not changed[row]:
            out.append(None)
            continue
        lines = range(first[row], first[row + 1])
        out.append(b"\n".join(data[seen["_line_start"][i]: seen["_line_end"][i]]
                              for i in lines if not seen["_failed"][i]).decode("utf-8", "replace"))
    return out


#: Bytes of text judged at a time: a byte takes over a hundred meanwhile, which a worker may not give back.
BATCH_BYTES = 500_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    rules: LineRules = LineRules()) -> DataFrame:
    """One row per document: counts, base_failed, kept, lines and characters removed."""
    def judge(batch):
        seen = analyse(batch.column(1), rules)
        longs = [pa.array(seen[k].astype(np.int64)) for k in (*COUNTS, "n_failed_lines", "lost_chars")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *longs[:5], pa.array(seen["base_failed"]), pa.array(seen["kept"]), *longs[5:]],
            names=["doc_id", *COUNTS, "base_failed", "kept", "n_failed_lines", "lost_chars"])

    schema = ("doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
              + ", base_failed boolean, kept boolean, n_failed_lines bigint, lost_chars bigint")
    return map_batches(docs.select(F.col(id_col).cast("bigint"), F.col(text_col)), judge, schema, BATCH_BYTES)


def clean_documents(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars",
                    rules: LineRules = LineRules()) -> DataFrame:
    """The kept documents, all their columns, with failed lines taken out of the text.

    ``chars_col``, if the table has it, is set to the new number of code points where
    lines were removed."""
    names = docs.columns

    def clean(batch):
        seen = analyse(batch.column(names.index(text_col)), rules)
        rows = np.flatnonzero(seen["kept"])
        texts = clean_texts(seen, rows)
        out = batch.take(pa.array(rows))
        i = names.index(text_col)
        old = out.column(i)
        columns = list(out.columns)
        if any(t is not None for t in texts):
            columns[i] = pa.array([old[k].as_py() if t is None else t for k, t in enumerate(texts)], old.type)
            if chars_col in names:
                j = names.index(chars_col)
                columns[j] = pa.array([out.column(j)[k].as_py() if t is None else len(t)
                                       for k, t in enumerate(texts)], out.column(j).type)
        yield pa.RecordBatch.from_arrays(columns, schema=out.schema)

    return map_batches(docs, clean, docs.schema, BATCH_BYTES)
