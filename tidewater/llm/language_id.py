"""Language identification with language-bitmask n-gram filters.

Training counts byte 4-grams of lower-cased words (with their boundaries) per language over
all training rows. An n-gram belongs to every language in which its rate is at least a set
share of its highest rate; that bitmask goes into a bit-sliced Bloom filter, an array of
masks in which one look-up returns all languages containing the n-gram. A text's n-grams
are looked up together; each language's popcount is corrected for the false positives that
its filling makes likely, and the highest corrected count decides.

The filter is gathered block by block from all tasks; its size is a parameter.

Defined results: null text, or a text without a letter, is ``und`` with score 0; with
nothing to learn from, every text is; ties go to the alphabetically first language; a text
whose n-grams are all unknown gets the language with most training rows and score 0;
repeated rows count and are judged each; further columns are ignored.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import map_batches
from ._text import LOWER, U64, mix, text_bytes
from .sketches import gather

UNKNOWN = "und"
SLOTS = 1 << 21
HASHES = 2
#: An n-gram belongs to a language if its rate there is at least this share of its highest.
RATE_SHARE = 0.2

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _letters(data: np.ndarray) -> np.ndarray:
    """Lower-cased bytes with every byte that is no letter turned into a space."""
    out = LOWER[data]
    behind = np.concatenate([[0], data[:-1]]) if len(data) else data
    capital = (behind == 0xC3) & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)  # Latin-1 capitals
    out = np.where(capital, out + 32, out).astype(np.uint8)
    out[~_LETTER[data]] = 32
    return out


def gram_codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(4-byte codes, document of each); a space stands at an n-gram's first or last place only."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    # a space on either side of every document
    padded = np.full(len(data) + 2 * n, 32, np.uint8)
    place = np.arange(len(data)) + 2 * np.repeat(np.arange(n), np.diff(offsets)) + 1
    padded[place] = _letters(data)
    if len(padded) < 4:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    space = padded == 32
    ok = ~space[1:-2] & ~space[2:-1]
    b = padded.astype(np.uint32)
    code = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
    at = np.flatnonzero(ok)
    return code[at], np.searchsorted(offsets[1:] + 2 * np.arange(1, n + 1), at, "right")


def _slots(codes: np.ndarray, slots: int) -> list[np.ndarray]:
    h = mix(codes.astype(U64))
    return [((h >> U64(32 * k)) & U64(slots - 1)).astype(np.int64) for k in range(HASHES)]


@dataclass
class LanguageFilter:
    languages: list[str]
    masks: np.ndarray
    prior: int = 0

    def __post_init__(self):
        fill = np.array([((self.masks >> self.masks.dtype.type(i)) & 1).mean() for i in range(len(self.languages))])
        self.false_rate = fill ** HASHES

    def popcounts(self, codes: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """Corrected popcount of each document and language."""
        found = self.masks[_slots(codes, len(self.masks))[0]]
        for at in _slots(codes, len(self.masks))[1:]:
            found &= self.masks[at]
        total = np.bincount(doc, minlength=n).astype(float)
        out = np.empty((n, len(self.languages)))
        for i in range(len(self.languages)):
            hits = np.bincount(doc, weights=(found >> found.dtype.type(i)) & 1, minlength=n)
            out[:, i] = np.maximum(hits - total * self.false_rate[i], 0) / (1 - self.false_rate[i] + 1e-12)
        return out

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        n = len(column)
        codes, doc = gram_codes(column)
        counts = self.popcounts(codes, doc, n)
        best = counts.argmax(axis=1)
        total = counts.sum(axis=1)
        score = np.divide(counts.max(axis=1), total, out=np.zeros(n), where=total > 0)
        best[total == 0] = self.prior
        data, offsets = text_bytes(column)
        plain = np.concatenate([[0], np.cumsum(_LETTER[data] & (data < 128))])
        lettered = plain[offsets[1:]] > plain[offsets[:-1]]
        for i in np.flatnonzero(~lettered):
            lettered[i] = any(c.isalpha() for c in column[i].as_py() or "")
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
        return names, np.where(lettered, np.clip(score, 0, 1), 0.0)


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", slots: int = SLOTS,
          rate_share: float = RATE_SHARE) -> LanguageFilter | None:
    """A filter from all rows with a language; None if there is none."""
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter("lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return None
    if len(languages) > 64:
        raise ValueError(f"{len(languages)} languages; a mask has 64 bits")
    dtype = next(d for d, bits in (("uint8", 8), ("uint16", 16), ("uint32", 32), ("uint64", 64)) if bits >= len(languages))
    number = {x: i for i, x in enumerate(languages)}

    def count(batch):
        codes, doc = gram_codes(batch.column(1))
        lang = np.array([number[x] for x in batch.column(0).to_pylist()], np.uint64)
        keys, n = np.unique((lang[doc] << U64(32)) | codes.astype(U64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array((keys & U64(0xFFFFFFFF)).astype(np.int64)),
                                          pa.array((keys >> U64(32)).astype(np.int32)), pa.array(n)], names=["code", "lang", "n"])

    counts = map_batches(rows, count, "code bigint, lang int, n bigint").groupBy("code", "lang").agg(F.sum("n").alias("n"))
    counts = counts.groupBy("code").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))  # 64 at most
    totals = {r["lang"]: r["n"] for r in counts.select(F.explode("by").alias("lang", "n")).groupBy("lang")
              .agg(F.sum("n").alias("n")).collect()}
    rates = F.array(*[F.coalesce(F.try_element_at("by", F.lit(i)), F.lit(0)) / F.lit(float(totals.get(i) or 1))
                      for i in range(len(languages))])
    share = F.transform("rates", lambda r: (r > 0) & (r >= rate_share * F.array_max("rates")))
    grams = counts.select("code", rates.alias("rates")).select("code", share.alias("member"))

    def fill(values, batch):
        member = np.array(batch.column(1).to_pylist(), bool).reshape(batch.num_rows, len(languages))
        mask = (member * (1 << np.arange(len(languages), dtype=np.uint64))).sum(axis=1).astype(dtype)
        for at in _slots(batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint32), slots):
            np.bitwise_or.at(values, at, mask)

    masks = gather(grams, slots, dtype, fill, np.bitwise_or)
    prior = languages.index(max(languages, key=lambda x: (sizes[x], -number[x])))
    return LanguageFilter(languages, masks, prior)


def identify(docs: DataFrame, model: LanguageFilter | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        if shared.value is None:
            names, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
        else:
            names, score = shared.value.predict(batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score)],
                                         names=["doc_id", "lang_pred", "score"])

    return map_batches(docs.select(F.col(id_col).cast("bigint"), F.col(text_col)), run,
                       "doc_id bigint, lang_pred string, score double")
