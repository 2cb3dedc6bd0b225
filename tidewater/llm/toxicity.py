"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Labelled rows (a bounded sample, ``max_examples``, chosen by a hash of the id) span the
space: all their words are its terms, and some stems of longer words. Document frequencies
of these terms are counted over all documents. Terms that tell toxic texts apart (words and
stems with a chi-squared value over ``min_chi``, taken greedily while they cover toxic
examples that lack better terms, so that the chance words of one much copied text don't
enter) weigh more by the root of that value; stems are terms only if they do. Words of a
text that no example has count in its norm only. Examples become unit vectors; equal
vectors are one entry with its counts. A text's nearest entries are exact: terms of few
entries are summed over their postings, those of many by a matrix product in single
precision, and entries that come near the k-th best sum are summed again in double.
Distance-weighted votes give a raw score, which an isotonic fit over two-fold scores of the
examples calibrates; the nearest examples' ids are the evidence.

Defined results: null or empty text has no terms and gets the score of such examples (the
share of toxic ones if there are none, 0 where there are no labels); ties in cosine go to
the lower entry number; repeated rows are scored each, a label given twice counts as toxic
if either says so; further columns are ignored.
"""
from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import checkpoint, cut, map_batches
from ._text import LOWER, U64, SpanHash, mix, per_doc, text_bytes

MAX_EXAMPLES = 20_000
MIN_CHI = 30.0
MIN_SHARE = 0.3     # of a term's examples are toxic at least
COVER = 4           # terms wanted in a toxic example
STEMS = (4, 5, 6, 7)  # first letters of longer words
NEIGHBOURS = 15
COMMON = 0.06       # a term of more than this share of the entries goes to the matrix
BLOCK = 256         # texts of one matrix product
CROWDED = 32        # terms with the same first bits, of as many bits as tell their number
ROUNDING = 1e-5     # more than single precision loses in a cosine

_WORD = np.zeros(256, bool)
_WORD[65:91] = _WORD[97:123] = _WORD[128:] = True


def text_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(64-bit terms, document of each, number of words): every word, then the stems that
    words go beyond."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    n = len(offsets) - 1
    inside = _WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    if not len(data):
        return np.zeros(0, U64), np.zeros(0, np.int64), 0
    starts = np.flatnonzero(inside & (~np.concatenate([[False], inside[:-1]]) | edge[:-1]))
    ends = np.flatnonzero(inside & (~np.concatenate([inside[1:], [False]]) | edge[1:])) + 1
    doc = np.searchsorted(offsets, starts, "right") - 1
    lead = (data & 0xC0) != 0x80
    first = np.cumsum(lead) - 1  # number of the character a byte belongs to
    places = np.append(np.flatnonzero(lead), len(data))
    hashed = SpanHash(data)
    terms, docs = [hashed(starts, ends)], [doc]
    for k in STEMS:
        stop = places[np.minimum(first[starts] + k, len(places) - 1)]
        longer = np.flatnonzero(stop < ends)
        terms.append(mix(hashed(starts[longer], stop[longer]) ^ U64(k)))
        docs.append(doc[longer])
    return np.concatenate(terms), np.concatenate(docs), len(starts)


# ------------------------------------------------------------------ index and votes

@dataclass
class Index:
    """Inverted index over unit vectors; entries carry n and n_toxic."""

    terms: np.ndarray            # hashes: sorted words, then sorted stems
    idf: np.ndarray              # weights of the terms and, last, of words that are none
    n: np.ndarray
    toxic: np.ndarray
    evidence: list[int | None]
    n_words: int = 0             # of the terms
    first: np.ndarray | None = None      # by term: its first posting; with the end
    entries: np.ndarray | None = None
    weights: np.ndarray | None = None
    column: np.ndarray | None = None     # by term: its column in the matrix or -1
    begin: np.ndarray | None = None      # by entry: its first weight in the matrix; with the end
    columns: np.ndarray | None = None
    values: np.ndarray | None = None
    norm: np.ndarray | None = None       # by entry, if its weights are roots of counts times ``idf``
    empty_rate: float = 0.0
    curve: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def build(cls, terms, idf, vectors: list[dict[int, float]], n, toxic, evidence, empty_rate, n_words=0) -> "Index":
        sizes = [len(v) for v in vectors]
        return cls.pack(terms, idf, np.repeat(np.arange(len(vectors)), sizes),
                        np.array([t for v in vectors for t in v], np.int64),
                        np.array([w for v in vectors for w in v.values()], float), n, toxic, evidence, empty_rate, n_words)

    @classmethod
    def pack(cls, terms, idf, entry, term, weight, n, toxic, evidence, empty_rate, n_words, norm=None) -> "Index":
        """From (entry, term, weight) arrays."""
        out = cls(terms, idf, np.asarray(n, float), np.asarray(toxic, float), evidence, n_words, norm=norm, empty_rate=empty_rate)
        n_in = np.bincount(term, minlength=len(idf))
        many = np.flatnonzero(n_in > max(COMMON * len(out.n), NEIGHBOURS))
        out.column = np.full(len(idf), -1, np.int32)
        out.column[many] = np.arange(len(many))
        wide = np.flatnonzero(out.column[term] >= 0)
        wide = wide[np.argsort(entry[wide], kind="stable")]
        out.begin = np.searchsorted(entry[wide], np.arange(len(out.n) + 1))
        out.columns, out.values = _small(out.column[term[wide]]), weight[wide]
        rest = np.flatnonzero(out.column[term] < 0)
        rest = rest[np.lexsort((entry[rest], term[rest]))]
        out.entries, out.weights = _small(entry[rest]), weight[rest]
        out.first = np.searchsorted(term[rest], np.arange(len(idf) + 1)).astype(np.int32)
        return out

    def _parts(self):
        """The weights' names, with the entry and the term of each."""
        yield "weights", self.entries, np.repeat(np.arange(len(self.idf)), np.diff(self.first))
        yield "values", np.repeat(np.arange(len(self.n)), np.diff(self.begin)), np.flatnonzero(self.column >= 0)[self.columns]

    def __getstate__(self):
        state = {k: v for k, v in self.__dict__.items() if k not in ("_matrix", "_cache")}
        if self.norm is not None:  # counts are a fraction of the weights' bytes
            for name, entry, term in self._parts():
                state[name] = _small(np.rint((state[name] * self.norm[entry] / self.idf[term]) ** 2).astype(np.int64))
        return state

    def __setstate__(self, state):
        self.__dict__.update(state)
        if self.norm is not None:
            for name, entry, term in self._parts():
                setattr(self, name, np.sqrt(state[name].astype(float)) * self.idf[term] / self.norm[entry])

    @property
    def matrix(self) -> np.ndarray:
        """(term of many entries, entry), in single precision; made where it is used."""
        if "_matrix" not in self.__dict__:
            self._matrix = np.zeros((int(self.column.max(initial=-1)) + 1, len(self.n)), np.float32)
            self._matrix[self.columns, np.repeat(np.arange(len(self.n)), np.diff(self.begin))] = self.values
        return self._matrix

    @property
    def cache(self) -> dict:
        """Results by text vector, kept where they are used."""
        return self.__dict__.setdefault("_cache", {})

    def search(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each vector (terms, weights) the k entries with the highest cosine above
        zero, exactly, and their cosines."""
        wide = np.zeros((len(vectors), len(self.matrix)))
        for q, (terms, weights) in zip(wide, vectors, strict=True):
            column = self.column[terms]
            q[column[column >= 0]] = weights[column >= 0]
        rough = wide.astype(np.float32) @ self.matrix
        return [self._best(terms, weights, q, r, k) for (terms, weights), q, r in zip(vectors, wide, rough, strict=True)]

    def _best(self, terms, weights, wide, rough, k):
        at, sizes = _spans(self.first[terms], self.first[terms + 1])
        scores = np.bincount(self.entries[at], self.weights[at] * np.repeat(weights, sizes), minlength=len(self.n))
        near = scores + rough
        known = np.partition(near, -k)[-k] if len(near) > k else 0.0
        some = np.flatnonzero(near >= known - ROUNDING)
        at, sizes = _spans(self.begin[some], self.begin[some + 1])
        exact = scores[some] + np.bincount(np.repeat(np.arange(len(some)), sizes), self.values[at] * wide[self.columns[at]],
                                           minlength=len(some))
        hit = exact > 0
        some, exact = some[hit], exact[hit]
        best = np.lexsort((some, -exact))[:k]
        return some[best], exact[best]

    def nearest(self, vector: dict[int, float], k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        return self.search([(np.array(list(vector), np.int64), np.array(list(vector.values()), float))], k)[0]

    def raw(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, list[int]]]:
        """For each: distance-weighted share of toxic examples among the nearest; their ids."""
        out: list[tuple[float, list[int]]] = [(self.empty_rate, [])] * len(vectors)
        full = [i for i, (terms, _) in enumerate(vectors) if len(terms)]
        for start in range(0, len(full), BLOCK):
            some = full[start: start + BLOCK]
            for i, (ids, cosines) in zip(some, self.search([vectors[i] for i in some]), strict=True):
                weight = self.n[ids] / (1.02 - np.minimum(cosines, 1))
                rate = self.toxic[ids] / self.n[ids]
                # the rate of examples without words votes like one neighbour at cosine 0
                score = (float(weight @ rate) + self.empty_rate / 1.02) / (float(weight.sum()) + 1 / 1.02)
                out[i] = score, [self.evidence[j] for j in ids[:3] if self.evidence[j] is not None]
        return out

    def score(self, raw: float) -> float:
        # a small share of the raw score keeps the order within a pooled block
        return 0.98 * float(np.interp(raw, *self.curve)) + 0.02 * raw if self.curve else raw

    def vector(self, counts: dict[int, int]) -> dict[int, float]:
        v = {t: np.sqrt(c) * self.idf[t] for t, c in counts.items()}
        norm = np.sqrt(sum(w * w for w in v.values()))
        return {t: w / norm for t, w in sorted(v.items())} if norm else {}


def _small(x: np.ndarray) -> np.ndarray:
    """The same numbers, none below zero, in the smallest type."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def _spans(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of these ranges one behind the other, and the sizes of the ranges."""
    sizes = end - begin
    stop = np.cumsum(sizes)
    return np.arange(stop[-1] if len(stop) else 0) + np.repeat(begin - stop + sizes, sizes), sizes


def isotonic(raw: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (raw score, pooled rate) at both ends of every pooled block."""
    blocks: list[list[float]] = []  # lowest and highest raw score, toxic ones, all
    for r, t, m in sorted(zip(raw, y, n, strict=True)):
        blocks.append([r, r, t, m])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, high, t2, m2 = blocks.pop()
            blocks[-1] = [blocks[-1][0], high, blocks[-1][2] + t2, blocks[-1][3] + m2]
    x = np.array([-1e-9, *[e for b in blocks for e in b[:2]], 1 + 1e-9])
    v = np.array([0.0, *[b[2] / b[3] for b in blocks for _ in range(2)], 1.0])
    x = x + np.arange(len(x)) * 1e-12  # ends of one-point blocks in order
    return x, np.maximum.accumulate(v)


def choose_terms(rows: list[tuple[int, bool, list[int]]], chi: dict[int, float], cover: int = COVER) -> np.ndarray:
    """Greedy choice by chi-squared: a term enters if enough toxic examples still lack terms."""
    at: dict[int, list[int]] = {t: [] for t in chi}
    for i, (_, toxic, terms) in enumerate(rows):
        if toxic:
            for t in terms:
                at[t].append(i)
    have = [0] * len(rows)
    out, sets = [], []
    for t in sorted(chi, key=lambda x: (-chi[x], x)):
        own = at[t]
        lacking = sum(have[i] < cover for i in own)
        here = set(own)
        # a stem of a chosen term, or a word of the same copies, tells nothing new
        if lacking >= 3 and lacking >= 0.05 * len(own) and not any(
                len(here & x) >= 0.9 * max(len(here), len(x)) for x in sets):
            out.append(t)
            sets.append(here)
            for i in own:
                have[i] += 1
    return np.sort(np.array(out, np.int64).view(U64))


# ------------------------------------------------------------------ fitting on Spark

def _sorted_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct words, then its distinct stems: (hash, document, is a stem, count)."""
    found, doc, n_words = text_terms(column)
    stem = np.arange(len(found)) >= n_words
    order = np.lexsort((found, stem, doc))
    found, doc, stem = found[order], doc[order], stem[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1]) | (stem[1:] != stem[:-1])
    at = np.flatnonzero(new)
    return found[at], doc[at], stem[at], np.diff(np.append(at, len(found)))


def _places(found: np.ndarray, terms: np.ndarray, low: int, high: int) -> np.ndarray:
    """The number of each hash among terms[low:high], -1 if it is none."""
    if low == high:
        return np.full(len(found), -1)
    if 4 * len(found) > high - low and (held := _by_first_bits(found, terms[low:high])) is not None:
        return np.where(held < 0, -1, held + low)
    at = np.minimum(np.searchsorted(terms[low:high], found), high - low - 1) + low
    return np.where(terms[at] == found, at, -1)


def _by_first_bits(found: np.ndarray, terms: np.ndarray) -> np.ndarray | None:
    """The place of each hash in the sorted terms or -1: its first bits tell the few terms it may be.
    None where the terms are no hashes, so that many have the same first bits."""
    bits = len(terms).bit_length()
    size = np.bincount((terms >> U64(64 - bits)).astype(np.int64), minlength=1 << bits)
    if (most := int(size.max())) > CROWDED:
        return None
    first = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    own = (found >> U64(64 - bits)).astype(np.int64)
    at, end = first[own], first[own + 1]
    out = np.full(len(found), -1)
    left = np.flatnonzero(at < end)
    for _ in range(most):
        here = at[left]
        hit = terms[here] == found[left]
        out[left[hit]] = here[hit]
        left = left[~hit & (here + 1 < end[left])]
        at[left] += 1
    return out


def _counts(column: pa.Array, terms: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first entry of each text, with the end; its terms and their counts. The number
    behind the last term stands for all words that are none."""
    found, doc, here = text_terms(column)
    words = _places(found[:here], terms, 0, n_words)
    place = np.concatenate([np.where(words < 0, len(terms), words), _places(found[here:], terms, n_words, len(terms))])
    inside = place >= 0
    key = np.sort(doc[inside] * (len(terms) + 1) + place[inside])
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
    doc, place = np.divmod(key[at], len(terms) + 1)
    return per_doc(doc, len(column)), place, np.diff(np.append(at, len(key)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_examples: int = MAX_EXAMPLES, min_chi: float = MIN_CHI) -> Index:
    """``labels`` holds the rows to learn from: (id_col, label_col)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    known = (labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
             .filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n_known = known.count()
    if n_known > max_examples:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * max_examples / n_known))

    def terms_of(batch):
        found, doc, _, _ = _sorted_terms(batch.column(2))
        lists = pa.ListArray.from_arrays(pa.array(per_doc(doc, batch.num_rows), pa.int32()), pa.array(found.view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["doc_id", "toxic", "terms"])

    # at most about max_examples rows of two numbers: bounded, so sent to every task
    chosen = rows.join(F.broadcast(known), "doc_id").select("doc_id", "toxic", "text")
    examples = checkpoint(map_batches(chosen, terms_of, "doc_id bigint, toxic int, terms array<bigint>"))
    once = examples.groupBy(F.xxhash64("terms").alias("same")).agg(F.max("toxic").alias("toxic"), F.first("terms").alias("terms"))
    total = once.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    n, toxic = total["n"], total["toxic"] or 0
    empty = Index.build(np.zeros(0, U64), np.ones(1), [], [], [], [], 0.0)
    if not 0 < toxic < n:
        empty.empty_rate = 1.0 if n and toxic == n else 0.0
        return empty
    rate = toxic / n
    by_term = (once.select(F.explode("terms").alias("term"), "toxic").groupBy("term")
               .agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")))
    expected = F.col("n") * rate
    chi = F.pow(F.col("toxic") - expected, 2) / expected / (1 - rate)
    told = (by_term.filter((F.col("toxic") >= MIN_SHARE * F.col("n")) & (F.col("toxic") > expected))
            .withColumn("chi", chi).filter(F.col("chi") >= min_chi))
    values = {r["term"]: r["chi"] for r in told.collect()}  # bounded by the sample
    told_list = spark.sparkContext.broadcast(np.sort(np.array(list(values), np.int64)))

    def only_told(batches):
        for batch in batches:
            told_terms = set(told_list.value.tolist())
            lists = [[t for t in x if t in told_terms] for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.int64()))],
                                             names=["doc_id", "toxic", "terms"])

    small = examples.mapInArrow(only_told, "doc_id bigint, toxic int, terms array<bigint>")
    rows_seen = [(r["doc_id"], bool(r["toxic"]), r["terms"]) for r in small.filter("toxic = 1").collect()]
    telling = choose_terms(rows_seen, values)

    telling_list = spark.sparkContext.broadcast(telling)

    def words_of(batch):  # and telling stems
        found, doc, stem, count = _sorted_terms(batch.column(2))
        stays = ~stem | np.isin(found, telling_list.value)
        first = pa.array(per_doc(doc[stays], batch.num_rows), pa.int32())
        kept = (found.view(np.int64)[stays], stem[stays], count[stays].astype(np.int32))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1),
                                          *(pa.ListArray.from_arrays(first, pa.array(x)) for x in kept)],
                                         names=["doc_id", "toxic", "terms", "stems", "counts"])

    # the sample is bounded, so its words are too
    sample = map_batches(chosen, words_of, "doc_id bigint, toxic int, terms array<bigint>, stems array<boolean>, "
                                           "counts array<int>").toArrow()
    ids, is_toxic = sample["doc_id"].to_numpy(), sample["toxic"].to_numpy()
    size = np.concatenate([np.diff(x.offsets.to_numpy()) for x in sample["terms"].chunks])
    order = np.argsort(ids, kind="stable")
    start = np.cumsum(size) - size
    at, _ = _spans(start[order], (start + size)[order])
    ids, is_toxic, size = ids[order], is_toxic[order], size[order]
    found, stem, count = (np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in sample[c].chunks])[at]
                          for c in ("terms", "stems", "counts"))
    del sample, at
    found = found.view(U64)
    words = np.unique(found[~stem])
    n_words = len(words)
    terms = np.concatenate([words, np.setdiff1d(telling, words)])
    place = _places(found, terms, 0, n_words).astype(np.int32)
    place[stem] = _places(found[stem], terms, n_words, len(terms))
    del found, stem, words
    pa.default_memory_pool().release_unused()
    shared = spark.sparkContext.broadcast(terms)

    def frequencies(batches):
        counts, n = np.zeros(len(shared.value), np.int64), 0
        for batch in (part for whole in batches for part in cut(whole)):
            _, place, _ = _counts(batch.column(0), shared.value, n_words)
            counts += np.bincount(place, minlength=len(counts) + 1)[:-1]
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.flatnonzero(counts), -1).astype(np.int32)),
                                          pa.array(np.append(counts[counts > 0], n))], names=["term", "n"])

    df = (rows.select("text").mapInArrow(frequencies, "term int, n bigint")
          .groupBy("term").agg(F.sum("n").alias("n")).toArrow())
    at, times = df["term"].to_numpy(), df["n"].to_numpy()
    frequency = np.zeros(len(terms))
    frequency[at[at >= 0]] = times[at >= 0]
    # a word that no example has weighs like one of a single document
    idf = np.log((1 + times[at < 0].sum()) / (1 + np.append(frequency, 1))) + 1
    for i in np.flatnonzero(np.isin(terms, telling)):
        idf[i] *= 1 + np.sqrt(values[int(terms[i].view(np.int64))])

    doc = np.repeat(np.arange(len(size), dtype=np.int32), size)
    first = per_doc(doc, len(size))
    # equal vectors are one entry; examples without words none
    numbers: dict[tuple[bytes, bytes], int] = {}
    entry = np.full(len(size), -1)
    for i in range(len(size)):
        own = slice(first[i], first[i + 1])
        if own.stop > own.start:
            entry[i] = numbers.setdefault((place[own].tobytes(), count[own].tobytes()), len(numbers))
    full, heads = np.unique(entry[entry >= 0], return_index=True)
    heads = np.flatnonzero(entry >= 0)[heads]
    n_of = np.bincount(entry[entry >= 0], minlength=len(full))
    toxic_of = np.bincount(entry[entry >= 0], is_toxic[entry >= 0], minlength=len(full))
    ids = ids[heads]
    bare_n, bare_toxic = int((entry < 0).sum()), int(is_toxic[entry < 0].sum())
    empty_rate = bare_toxic / bare_n if bare_n else rate
    once_each = np.isin(doc, heads)
    owner, term = entry[doc[once_each]].astype(np.int32), place[once_each]
    weight = np.sqrt(count[once_each]) * idf[term]
    del doc, place, count, once_each
    norm = np.sqrt(np.bincount(owner, weight ** 2, minlength=len(full)))
    weight /= norm[owner]

    def part(some):
        number = np.cumsum(some) - 1
        here = some[owner]
        return Index.pack(terms, idf, number[owner[here]], term[here], weight[here], n_of[some], toxic_of[some],
                          ids[some].tolist(), empty_rate, n_words, norm[some])

    even = np.arange(len(full)) % 2 == 0
    of = np.searchsorted(owner, np.arange(len(full) + 1))
    vectors = [(term[of[i]: of[i + 1]], weight[of[i]: of[i + 1]]) for i in range(len(full))]
    raw = np.zeros(len(full))
    for own in (even, ~even):
        raw[own] = [x[0] for x in part(~own).raw([vectors[i] for i in np.flatnonzero(own)])]
    out = part(np.ones(len(full), bool))
    extra = [bare_n] if bare_n else []
    out.curve = isotonic(np.append(raw, [empty_rate] * len(extra)), np.append(toxic_of, [bare_toxic] * len(extra)),
                         np.append(n_of, extra).astype(float))
    return out


def score_documents(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = 0.7) -> DataFrame:
    """doc_id, score, predicted, evidence (ids of the nearest labelled examples)."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batch):
        known = shared.value
        cache = known.cache
        if len(cache) > 100_000:
            cache.clear()
        first, terms, counts = _counts(batch.column(1), known.terms, known.n_words)
        weights = np.sqrt(counts) * known.idf[terms]
        doc = np.repeat(np.arange(batch.num_rows), np.diff(first))
        weights /= np.sqrt(np.bincount(doc, weights ** 2, minlength=batch.num_rows))[doc]
        spans = [slice(a, b) for a, b in zip(first[:-1], first[1:], strict=True)]
        keys = [hashlib.sha256(terms[x].tobytes() + counts[x].tobytes()).digest() for x in spans]
        new = {key: x for key, x in zip(keys, spans, strict=True) if key not in cache}
        for key, (raw, ids) in zip(new, known.raw([(terms[x], weights[x]) for x in new.values()]), strict=True):
            cache[key] = known.score(raw), ids
        scores, evidence = [cache[key][0] for key in keys], [cache[key][1] for key in keys]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()),
            pa.array(evidence, pa.list_(pa.int64()))], names=["doc_id", "score", "predicted", "evidence"])

    return map_batches(docs.select(F.col(id_col).cast("bigint"), F.col(text_col)), run,
                       "doc_id bigint, score double, predicted int, evidence array<bigint>")

