"""Spelling variant grouping: near words found by dynamic programming down sorted lists.

Words one inserted, deleted or replaced character apart share the half in front of the edit or
the half behind it. So every word goes, as itself and reversed, into the sorted list of the words
that begin like it, once with the words as long as it or longer, once as the longer one. In a
list, a word's edit matrix against the list is computed along one diagonal band of three cells,
one row for each character of the list's words; rows of a prefix shared with the word before are
not computed again, and a range of words whose shared prefix already exceeds one edit is skipped.
The words of many lists run down their own lists at once, by array operations.

A list longer than ``limit`` words is cut by one more character until its parts fit; what lies
across the cut differs in just that character and meets in lists of words that are equal
without it, which no alphabet makes long. So no list grows with the corpus, and no pair is lost.

Chains of forms double in reach each round; a form has at least twice its word's count, so there
are few rounds.

Defined results: null texts have no words; a null id counts as an empty one in checksums; words of
any length count, also those of a text that is one word; repeated rows count as often as they
are there; ties go to the smallest word in code point order; a table without words gives no
rows; further columns are ignored. Words are runs of A-Z, a-z and U+00C0 to U+00FF, so each of
their characters is one byte of Latin-1.
"""
from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import checkpoint, cut
from ._text import LOWER, text_bytes

MIN_CHARS, MIN_COUNT = 5, 3
#: A run whose checksum this number divides loses a character.
DAMAGED = 97
#: Words of one list, at most.
LIMIT = 50_000
#: Cells of one word matrix, about.
CELLS = 4_000_000
#: First byte of U+00C0 to U+00FF in UTF-8.
LEAD = 0xC3
IS_ASCII_LETTER = np.zeros(256, bool)
IS_ASCII_LETTER[65:91] = IS_ASCII_LETTER[97:123] = True
#: Longest run, in bytes, whose checksum is taken together with others'.
SHORT = 48


def _steps() -> np.ndarray:
    """The 256 steps of CRC-32 (reflected polynomial 0xEDB88320)."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


STEPS = _steps()


# ------------------------------------------------------------------ words and counts

def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every maximal run of letters."""
    lead = data == LEAD
    inside = IS_ASCII_LETTER[data] | lead
    inside[1:] |= lead[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """CRC-32 of spans, each going on from a checksum already begun."""
    length = ends - starts
    order = np.argsort(-length, kind="stable")
    at, falling = starts[order], -length[order]
    c = (begun[order] ^ np.uint32(0xFFFFFFFF)).astype(np.uint32)
    long = int(np.searchsorted(falling, -SHORT, "left"))  # these are longer than SHORT
    raw = data.tobytes() if long else b""
    for i in range(long):
        s = int(at[i])
        c[i] = zlib.crc32(raw[s: s - int(falling[i])], int(c[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    for k in range(int(-falling[long]) if long < len(c) else 0):
        n = int(np.searchsorted(falling, -k, "left"))
        own = c[long:n]
        c[long:n] = STEPS[(own ^ data[at[long:n] + k]) & np.uint32(255)] ^ (own >> np.uint32(8))
    out = np.empty(len(c), np.uint32)
    out[order] = c ^ np.uint32(0xFFFFFFFF)
    return out


def _batch_words(ids: list, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends, doc = letter_runs(data, offsets)
    if not len(starts):
        return
    begun = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    h = checksums(data, starts, ends, begun[doc])
    chars = ends - starts - np.diff(np.concatenate([[0], np.cumsum(data == LEAD)])[np.stack([starts, ends])], axis=0)[0]
    damaged = h % DAMAGED == 0
    changed: Counter[str] = Counter()
    for i in np.flatnonzero(damaged & (chars > MIN_CHARS)).tolist():
        word = data[starts[i]: ends[i]].tobytes().decode()
        at = int(h[i]) % len(word)
        changed[word[:at] + word[at + 1:]] += 1
    whole = ~damaged & (chars >= MIN_CHARS)
    starts, ends = starts[whole], ends[whole]
    marks = np.zeros(len(data) + 1, np.int8)
    marks[starts] += 1
    marks[ends] -= 1
    own = data[np.cumsum(marks[:-1], dtype=np.int8) > 0]
    bounds = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(own.tobytes()))
    found = pc.value_counts(words)
    names = ["word", "n"]
    yield pa.RecordBatch.from_arrays([found.field(0).cast(pa.string()), found.field(1)], names=names)
    if changed:
        yield pa.RecordBatch.from_arrays([pa.array(changed.keys(), pa.string()), pa.array(changed.values(), pa.int64())],
                                         names=names)


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: the words of all texts after the damage, with at least ``min_count`` occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in cut(whole, 8_000_000):
                yield from _batch_words(batch.column(0).to_pylist(), batch.column(1))

    words = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(run, "word string, n bigint")
    return words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# ------------------------------------------------------------------ lists

#: Parts of a row's list: by prefix; by what is left without a character, for replaced ones
#: and for inserted ones.
BY_PREFIX, REPLACED, INSERTED = 0, 1, 2
LIST = ["m", "side", "part", "share", "key"]


def _in_lists(words: DataFrame) -> DataFrame:
    """Every word in its four lists: m (length of the shorter word of a pair), side (1: reversed)."""
    length = F.length("word")
    spots = F.array(*[F.struct(m.alias("m"), F.lit(side).alias("side"))
                      for m in (length, length - 1) for side in (0, 1)])
    rows = words.select("word", "n", F.explode(spots).alias("at")).select("word", "n", "at.m", "at.side")
    return _by_prefix(rows.filter(F.col("m") >= MIN_CHARS)
                      .withColumn("o", F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word"))).drop("word"),
                      F.floor(F.col("m") / 2).cast("int"))


def _by_prefix(rows: DataFrame, share) -> DataFrame:
    return (rows.withColumn("part", F.lit(BY_PREFIX)).withColumn("share", share)
            .withColumn("key", F.expr("left(o, share)")).select(*LIST, "o", "n"))


def _across(rows: DataFrame) -> DataFrame:
    """Lists of the words of a cut list that are equal but for the character at the cut."""
    without = F.expr("concat(left(o, share), substring(o, share + 2))")
    shorter = F.length("o") == F.col("m")
    spots = F.when(shorter, F.array(F.struct(F.lit(REPLACED).alias("part"), without.alias("key")),
                                    F.struct(F.lit(INSERTED).alias("part"), F.col("o").alias("key")))
                   ).otherwise(F.array(F.struct(F.lit(INSERTED).alias("part"), without.alias("key"))))
    return (rows.drop("part", "key").withColumn("at", F.explode(spots))
            .select("m", "side", "at.part", "share", "at.key", "o", "n"))


def _lists(words: DataFrame, limit: int) -> DataFrame:
    """All lists, none by prefix longer than ``limit``."""
    done, rows = [], _in_lists(words)
    while True:
        long = rows.groupBy(*LIST).count().filter(F.col("count") > limit).select(*LIST)
        long = checkpoint(long)
        if long.isEmpty():
            return reduce(DataFrame.unionByName, [*done, rows])
        cut_up = checkpoint(rows.join(long, LIST, "left_semi"))
        done += [rows.join(long, LIST, "left_anti"), _across(cut_up)]
        rows = checkpoint(_by_prefix(cut_up.select("m", "side", "share", "o", "n"), F.col("share") + 1))


# ------------------------------------------------------------------ down the lists

def _matrix(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Latin-1 characters of words, one row each with zeros behind, and lengths."""
    data, offsets = text_bytes(words)
    lead = data == LEAD
    before = np.concatenate([[0], np.cumsum(lead)])[offsets]
    chars = np.where(data >= 0x80, data + np.uint8(0x40), data)[~lead].astype(np.uint8)
    bounds = offsets - before
    length = np.diff(bounds)
    out = np.zeros((len(length), int(length.max(initial=0)) + 2), np.uint8)
    row = np.repeat(np.arange(len(length)), length)
    out[row, np.arange(len(chars)) - bounds[row]] = chars
    return out, length


def _shared(words: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Length of the prefix each row shares with the row before."""
    out = np.zeros(len(words), np.int64)
    if len(words) > 1:
        same = words[1:] == words[:-1]
        least = np.minimum(length[1:], length[:-1])
        out[1:] = np.minimum(np.argmin(np.column_stack([same, np.zeros(len(same), bool)]), axis=1), least)
    return out


def near_pairs(words: np.ndarray, length: np.ndarray, first: np.ndarray, last: np.ndarray, m: np.ndarray,
               share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows one edit apart within sorted lists ``first[i] <= i < last[i]``, whose words
    share at least ``share`` characters. One of a pair has length m; of two such, each comes once."""
    n, width = words.shape
    lcp = _shared(words, length)
    lcp[first == np.arange(n)] = -1
    # after[d, i]: the first row behind i that does not share d characters with it
    after = np.empty((width + 1, n + 1), np.int32)
    rows = np.arange(n)
    for d in range(width + 1):
        ends = np.append(np.where(lcp < d, rows, n), n)
        after[d] = np.minimum.accumulate(ends[::-1])[::-1]
    query = np.flatnonzero(length == m)
    # a list cut behind all of a word's characters begins with that word
    query = query[first[query] + (length[first[query]] <= share[query]) < last[query]]
    band = np.full((len(query), width + 1, 3), 2, np.int8)  # rows of the matrix by depth
    slot = np.arange(len(query))
    band[slot, share[query]] = (1, 0, 1)
    at, depth = first[query] + (length[first[query]] <= share[query]), share[query].astype(np.int64)
    found_a, found_b = [], []
    while len(slot):
        q = query[slot]
        old = band[slot, depth]
        c = words[at, depth]
        e0 = np.minimum(old[:, 0] + (words[q, depth - 1] != c), old[:, 1] + 1)
        e1 = np.minimum(np.minimum(old[:, 1] + (words[q, depth] != c), old[:, 2] + 1), e0 + 1)
        e2 = np.minimum(old[:, 2] + (words[q, depth + 1] != c), e1 + 1)
        depth += 1
        cells = np.stack([e0, e1, e2], axis=1).astype(np.int8)
        band[slot, depth] = cells
        over = cells.min(axis=1) > 1
        whole = ~over & (depth == length[at])
        hit = np.flatnonzero(whole)
        if len(hit):
            a, b = q[hit], at[hit]
            near = (cells[hit, length[a] - length[b] + 1] == 1) & ((length[b] > length[a]) | (b > a))
            found_a.append(a[near])
            found_b.append(b[near])
        moved = over | whole
        at = np.where(over, after[np.minimum(depth, width), np.minimum(at + 1, n)], np.where(whole, at + 1, at))
        going = at < last[q]
        if not going.all():
            slot, at, depth, moved = slot[going], at[going], depth[going], moved[going]
        depth = np.where(moved, lcp[np.minimum(at, n - 1)], depth)
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def _own_pairs(words, length, m, side, part, share, a, b) -> np.ndarray:
    """Which pairs are this list's to report: across a cut, those that differ there; reversed, those
    that do not also share enough in front."""
    keep = np.ones(len(a), bool)
    across = part[a] != BY_PREFIX
    keep &= ~across | (words[a, share[a]] != words[b, share[a]])
    back = np.flatnonzero(side[a] == 1)
    if len(back):
        x, y, k = a[back], b[back], m[a[back]] // 2
        same = np.ones(len(back), bool)
        for t in range(int(k.max())):
            use = same & (t < k)
            same &= ~use | (words[x, length[x] - 1 - t] == words[y, length[y] - 1 - t])
        keep[back[same]] = False
    return keep


def _near_in_lists(m, side, part, share, first, last, o: pa.Array, n: np.ndarray) -> pa.RecordBatch | None:
    """word, n_near, best_n, best: near words counted over whole sorted lists."""
    words, length = _matrix(o)
    a, b = near_pairs(words, length, first, last, m, share)
    keep = _own_pairs(words, length, m, side, part, share, a, b)
    a, b = a[keep], b[keep]
    if not len(a):
        return None
    mine, other = np.concatenate([a, b]), np.concatenate([b, a])
    # reversed words are turned back
    used, where = np.unique(np.concatenate([mine, other]), return_inverse=True)
    texts = [bytes(words[i, : length[i]][::-1] if side[i] else words[i, : length[i]]).decode("latin-1") for i in used.tolist()]
    rank = np.empty(len(texts), np.int64)
    rank[sorted(range(len(texts)), key=texts.__getitem__)] = np.arange(len(texts))
    mine_at, other_at = where[: len(mine)], where[len(mine):]
    order = np.lexsort([rank[other_at], -n[other], mine])
    begin = np.flatnonzero(np.concatenate([[True], np.diff(mine[order]) != 0]))
    count = np.diff(np.append(begin, len(order)))
    best = order[begin]
    return pa.RecordBatch.from_arrays(
        [pa.array([texts[i] for i in mine_at[best].tolist()], pa.string()), pa.array(count, pa.int64()),
         pa.array(n[other[best]], pa.int64()), pa.array([texts[i] for i in other_at[best].tolist()], pa.string())],
        names=["word", "n_near", "best_n", "best"])


def _chunks(batch: pa.Table) -> Iterator[tuple[int, int]]:
    """Ranges of whole lists whose word matrices stay near ``CELLS`` cells (m rises)."""
    m = batch.column("m").to_numpy()
    start, n = 0, len(m)
    new = _list_starts(batch)
    while start < n:
        stop = min(n, start + max(1, CELLS // (int(m[start]) + 3)))
        wide = int(np.searchsorted(m, 2 * m[start] + 8, "right"))
        stop = min(stop, max(wide, start + 1))
        if stop < n:  # back to a list's start, or on to the end of the one list
            k = int(np.searchsorted(new, stop, "right")) - 1
            stop = int(new[k]) if new[k] > start else int(new[k + 1]) if k + 1 < len(new) else n
        yield start, stop
        start = stop


def _list_starts(table: pa.Table) -> np.ndarray:
    if not table.num_rows:
        return np.zeros(0, np.int64)
    differs = np.zeros(table.num_rows, bool)
    differs[0] = True
    for name in LIST:
        col = table.column(name).combine_chunks()
        differs[1:] |= pc.not_equal(col.slice(1), col.slice(0, len(col) - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(differs)


def _scan(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Near words of whole lists, in order."""
    for start, stop in _chunks(table):
        part = table.slice(start, stop - start)
        new = _list_starts(part)
        size = np.diff(np.append(new, part.num_rows))
        m = part.column("m").to_numpy()
        chars = pc.utf8_length(part.column("o")).to_numpy()
        shorter = np.add.reduceat((chars == m).astype(np.int64), new)
        alive = np.repeat((size > 1) & (shorter > 0), size)
        if not alive.any():
            continue
        part = part.filter(pa.array(alive)).combine_chunks()
        new = _list_starts(part)
        size = np.diff(np.append(new, part.num_rows))
        cols = [part.column(c).to_numpy().astype(np.int64) for c in ("m", "side", "part", "share")]
        out = _near_in_lists(*cols, np.repeat(new, size), np.repeat(new + size, size),
                             part.column("o").combine_chunks(), part.column("n").to_numpy())
        if out is not None:
            yield out


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []  # all rows of the list still open, and whole lists before it
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < 200_000:
            continue
        table = pa.Table.from_batches(held)
        end = int(_list_starts(table)[-1])
        if end:
            yield from _scan(table.slice(0, end))
            table = table.slice(end).combine_chunks()
        held, rows = table.to_batches(), table.num_rows
    if held:
        yield from _scan(pa.Table.from_batches(held))


# ------------------------------------------------------------------ forms and roots

def near_words(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """word, n_near, best_n, best of every word with a near one."""
    lists = _lists(words, limit).repartition(*LIST).sortWithinPartitions(*LIST, "o")
    found = lists.mapInArrow(_near, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.less")).alias("best_n"), "b.best"))


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: where each word's chain of forms ends."""
    roots = checkpoint(forms.select("word", F.col("form").alias("root")))
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = checkpoint(roots.join(on, "root", "left")
                           .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if roots.filter("moved").isEmpty():
            return roots.select("word", "root")


def group_variants(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """word, form, root, n, n_near, form_n of distinct words and counts (word, n)."""
    words = checkpoint(words.select("word", "n"))
    near = near_words(words, limit)
    has_form = F.col("best_n") >= 2 * F.col("n")
    judged = checkpoint(words.join(near, "word", "left").select(
        "word", F.when(has_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, F.col("best_n")).alias("form_n")))
    roots = _roots(judged.filter("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    return group_variants(count_words(docs, id_col, text_col), limit)
