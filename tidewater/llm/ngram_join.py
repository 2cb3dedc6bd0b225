"""N-gram Jaccard join with prefix trees.

A document's set is its distinct word n-grams (64-bit hashes of the lower-cased words); a
text with fewer words is one n-gram, a text without words an empty set that is linked with
nothing. Two sets are linked if intersection / union reaches the threshold, tested in
integers.

1. Equal sets become one node (copies are never paired).
2. All n-grams have one global order, that of their hashes. Of a linked set, a share of at most
   one less the threshold is missing in the other. So of the n-grams below a place in the order,
   all but that many must be in some other set; a set with too few of those is linked with nothing
   and takes no further part. Each task sends an n-gram once, in a few bytes, and counts those
   that several of its own sets have by itself.
   The order of what remains is cut into segments, more of them than two linked sets can have
   n-grams in which they differ, so linked sets agree in a whole segment. Sets with an equal
   segment are tied. Every task first folds its own
   documents: a segment is sent once per slice, with the smallest set it is tied to there, and each
   of the slice's other sets once with the one it is tied to; segments go packed, by parts. Nodes tied directly or over others form blocks; only nodes of one block can be linked.
3. A block's sets are stored in a trie, common n-grams first, so that close sets share long
   paths; sets with too few n-grams in common with any other stay out. All sets go down the trie together, the overlap of a shared path is counted once,
   and a set leaves a subtree when even its whole remaining length, or the subtree's, could
   not reach the overlap needed.
4. In a block of several chunks, n-grams that only one of its sets has are counted; sets with
   too many of them are linked with nothing and leave, and the others are tied anew, until
   that changes nothing more. What stays large is dealt into chunks. Each chunk is joined in itself, then the chunks' group
   heads among each other. Of the sets still apart afterwards, those that share an n-gram found in few
   sets are paired off, and what they share is counted; the few pairs these counts leave open are
   compared whole. Linked sets without such an n-gram consist mostly of frequent ones: these sets are tied
   anew by themselves and compared chunk by chunk. So no pair of a block goes unseen, no set is sent to
   every chunk of a block, and a group of near copies costs its members, not their pairs.

Defined results: a row with a null id is counted but linked with nothing; repeated rows
are equal sets; null text has no n-grams; an empty table gives no rows; other columns are
ignored. Hash collisions of 64 bits are taken as equal.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import checkpoint, cut, map_batches
from ._text import LOWER, U64, mix, per_doc, span_hashes, text_bytes, word_spans
from .components import components
from .sketches import gather

#: Most bits of the filter that tells which nodes' sets are wanted (16 for each node below that);
#: a larger share of false hits, in a corpus with more nodes, costs shuffled bytes only.
FILTER_BITS = 1 << 27
#: N-grams that one part of the count of common ones holds, about.
PART_GRAMS = 1_000_000
#: A chunk of a block holds about so many nodes, or n-grams.
CHUNK_NODES = 1000
CHUNK_GRAMS = 300_000
#: Sets still apart are paired off by the n-grams that at most so many sets of their block have.
RARE_SETS = 64
#: Pairs held at a time while they are counted.
PAIRS_HELD = 1_000_000


@dataclass(frozen=True)
class Similarity:
    words: int = 4
    percent: int = 85

    def linked(self, both, a, b):
        return 100 * both >= self.percent * (a + b - both)

    def needed(self, a, b):
        """Least overlap of linked sets of these sizes."""
        return -((-self.percent * (a + b)) // (100 + self.percent))

    def buckets(self, largest: int) -> np.ndarray:
        """Least size of each size bucket; linked sets lie in one bucket or in neighbours."""
        edges = [1]
        while edges[-1] <= largest:
            edges.append(max(edges[-1] + 1, 100 * (edges[-1] - 1) // self.percent + 1))
        return np.array([*edges, max(edges[-1] + 1, 100 * (edges[-1] - 1) // self.percent + 1)])

    def missing(self, size):
        """Most n-grams of a set of this size that a linked one lacks."""
        return size * (100 - self.percent) // 100

    def sampled(self) -> np.uint64:
        """N-grams below this hash are counted: more than can be missing, by about as much again as
        tells most unlinked sets."""
        return U64(min((1 << 64) - 1, (1 << 64) * 16 * (100 - self.percent) // 1000))

    def differ(self, largest):
        """Most n-grams that are in one only of two linked sets up to this size."""
        return 2 * largest * (100 - self.percent) // (100 + self.percent)


# ------------------------------------------------------------------ sets of a batch

#: Bytes of text whose n-grams are hashed at a time: a byte takes about a hundred meanwhile, which a
#: worker may not give back.
HASHED_BYTES = 250_000


def gram_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct n-gram hashes by document and value, where each document's begin)."""
    parts = [_gram_sets(part.column(0), words)
             for part in cut(pa.RecordBatch.from_arrays([column], names=["text"]), HASHED_BYTES)]
    ends = np.cumsum([0] + [len(value) for value, _ in parts])
    return (np.concatenate([value for value, _ in parts]),
            np.concatenate([[0], *[bounds[1:] + start for (_, bounds), start in zip(parts, ends[:-1], strict=True)]]))


def _gram_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(column)
    data = LOWER[data]
    n_docs = len(offsets) - 1
    starts, ends, doc = word_spans(data, offsets)
    h = span_hashes(data, starts, ends)
    count = np.diff(per_doc(doc, n_docs))
    grams, owner = [], []
    for size in range(1, words + 1):
        if len(h) < size:
            break
        acc = np.full(len(h) - size + 1, size, U64)
        for k in range(size):
            acc = mix(acc * U64(0x9FB21C651E98DF25) + h[k: len(h) - size + 1 + k])
        of = doc[: len(acc)]
        ok = (of == doc[size - 1:]) & ((count[of] == size) if size < words else True)
        grams.append(acc[ok])
        owner.append(of[ok])
    if not grams:
        return np.zeros(0, U64), np.zeros(n_docs + 1, np.int64)
    value, of = np.concatenate(grams), np.concatenate(owner)
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    return value[new], np.searchsorted(of[new], np.arange(n_docs + 1))


def node_ids(value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set; sets of equal n-grams have equal ids."""
    def total(x):
        s = np.concatenate([np.zeros(1, U64), np.cumsum(x)])
        return s[bounds[1:]] - s[bounds[:-1]]
    return mix(total(mix(value)) ^ mix(total(mix(value ^ U64(0x5DEECE66D)))) + np.diff(bounds).astype(U64)).view(np.int64)


def _first_of_each(nodes: np.ndarray, sizes: np.ndarray, usable: np.ndarray) -> np.ndarray:
    rows = np.flatnonzero((sizes > 0) & usable)
    return rows[np.unique(nodes[rows], return_index=True)[1]]


def _has_id(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column(0).is_valid())


# ------------------------------------------------------------------ trie join of a chunk

class Trie:
    """Sets as ascending rank arrays, in one compressed prefix tree (arrays by node)."""

    def __init__(self, ranks: list[np.ndarray], sizes: np.ndarray):
        order = sorted(range(len(ranks)), key=lambda i: ranks[i].astype(">u4").tobytes())
        self.order = np.array(order)
        run_from, run_to, run_set, parent, lo, hi = [0], [0], [order[0]], [-1], [0], [0]
        ends: list[list[int]] = [[]]
        stack = [0]
        last = np.zeros(0, np.uint32)
        for at, i in enumerate(order):
            own = ranks[i]
            m = min(len(last), len(own))
            differ = np.flatnonzero(last[:m] != own[:m])
            shared = int(differ[0]) if len(differ) else m
            while run_to[stack[-1]] > shared:
                node = stack.pop()
                hi[node] = at
                if run_from[node] < shared:  # split: the upper part becomes a node of its own
                    run_from.append(run_from[node]), run_to.append(shared), run_set.append(run_set[node])
                    parent.append(parent[node]), lo.append(lo[node]), hi.append(0), ends.append([])
                    run_from[node], parent[node] = shared, len(run_from) - 1
                    stack.append(len(run_from) - 1)
            if len(own) > shared:
                run_from.append(shared), run_to.append(len(own)), run_set.append(i)
                parent.append(stack[-1]), lo.append(at), hi.append(0), ends.append([])
                stack.append(len(run_from) - 1)
            ends[stack[-1]].append(i)
            last = own
        for node in stack:
            hi[node] = len(order)
        n = len(run_from)
        self.runs = [ranks[run_set[k]][run_from[k]: run_to[k]] for k in range(n)]
        self.ends, self.lo, self.hi = ends, lo, hi
        self.children: list[list[int]] = [[] for _ in range(n)]
        for k in range(1, n):
            self.children[parent[k]].append(k)
        sorted_sizes, lengths = sizes[self.order], np.array([len(ranks[i]) for i in order])
        self.min_size = [int(sorted_sizes[lo[k]: hi[k]].min()) for k in range(n)]
        self.max_size = [int(sorted_sizes[lo[k]: hi[k]].max()) for k in range(n)]
        self.max_rest = [int(lengths[lo[k]: hi[k]].max()) - run_to[k] for k in range(n)]


def _reaching(sides: list[list[np.ndarray]], rule: Similarity) -> tuple[list[np.ndarray], list[list[np.ndarray]]]:
    """(sets that can be linked, their ranks): a set needs its share of n-grams in common
    with another set (one side: the sets themselves) or with the other side's sets. Ranks
    count n-grams in common only, the most common first."""
    keep = [np.arange(len(side)) for side in sides]
    while True:
        sizes = [np.array([len(side[i]) for i in k], np.int64) for side, k in zip(sides, keep, strict=True)]
        if not all(len(k) for k in keep):
            return keep, [[] for _ in sides]
        every = np.concatenate([side[i] for side, k in zip(sides, keep, strict=True) for i in k])
        values, inverse, counts = np.unique(every, return_inverse=True, return_counts=True)
        if len(sides) == 1:
            common = counts > 1
        else:
            own = np.bincount(inverse[: sizes[0].sum()], minlength=len(values))
            common = (own > 0) & (own < counts)
        split = np.cumsum([0, *np.concatenate(sizes)])
        shared = np.concatenate([[0], np.cumsum(common[inverse])])
        enough = 100 * np.diff(shared[split]) >= rule.percent * np.concatenate(sizes)
        if enough.all():
            break
        cut = np.split(enough, np.cumsum([len(k) for k in keep])[:-1])
        keep = [k[e] for k, e in zip(keep, cut, strict=True)]
    order = np.argsort(np.where(common, -counts, 1), kind="stable")
    rank = np.empty(len(values), np.uint32)
    rank[order] = np.arange(len(values), dtype=np.uint32)
    n_common = int(common.sum())
    ranked = rank[inverse]
    out, at = [], 0
    for k in keep:
        own = []
        for _ in k:
            r = np.sort(ranked[split[at]: split[at + 1]])
            own.append(r[: np.searchsorted(r, n_common)])
            at += 1
        out.append(own)
    return keep, out


def trie_links(sets: list[np.ndarray], queries: list[np.ndarray] | None, rule: Similarity, label: np.ndarray,
               query_label: np.ndarray, matrix_bytes: int = 16_000_000) -> Iterator[tuple[int, np.ndarray]]:
    """(set, linked queries), without pairs whose labels are equal when their turn comes.

    No queries: the sets among themselves. The caller joins the labels of what is yielded
    before it asks for more."""
    keep, ranks = _reaching([sets] if queries is None else [sets, queries], rule)
    if not all(len(k) for k in keep):
        return
    set_ids, query_ids, own, asked = keep[0], keep[-1], ranks[0], ranks[-1]
    sizes = np.array([len(sets[i]) for i in set_ids])
    q_sizes = np.array([len((sets if queries is None else queries)[i]) for i in query_ids])
    n_common = 1 + max((int(r[-1]) for r in (*own, *asked) if len(r)), default=0)
    trie = Trie(own, sizes)
    in_order = set_ids[trie.order]
    step = max(1, matrix_bytes // n_common)
    for start in range(0, len(asked), step):
        some, ids = asked[start: start + step], query_ids[start: start + step]
        has = np.zeros((n_common, len(some)), np.uint8)
        for k, r in enumerate(some):
            has[r, k] = 1
        flat = np.concatenate([r.astype(np.int64) + k * n_common for k, r in enumerate(some)])
        q_from = np.cumsum([0] + [len(r) for r in some])
        size = q_sizes[start: start + step]
        stack = [(0, np.arange(len(some)), np.zeros(len(some), np.int64), q_from[1:] - q_from[:-1])]
        while stack:
            node, active, overlap, rest = stack.pop()
            below = label[in_order[trie.lo[node]: trie.hi[node]]]
            run = trie.runs[node]
            a = size[active]
            # in reach before the run is looked at: enough length left on both sides
            stays = ((overlap + np.minimum(rest, len(run) + trie.max_rest[node]) >= rule.needed(a, trie.min_size[node]))
                     & (100 * trie.max_size[node] >= rule.percent * a) & (rule.percent * trie.min_size[node] <= 100 * a))
            if (below == below[0]).all():
                stays &= query_label[ids[active]] != below[0]
            active, overlap, rest = active[stays], overlap[stays], rest[stays]
            if len(run) and len(active):
                overlap = overlap + has[run][:, active].sum(axis=0, dtype=np.int64)
                rest = q_from[active + 1] - np.searchsorted(flat, active * n_common + int(run[-1]), "right")
                stays = (overlap + np.minimum(rest, trie.max_rest[node])
                         >= rule.needed(size[active], trie.min_size[node]))
                active, overlap, rest = active[stays], overlap[stays], rest[stays]
            if not len(active):
                continue
            for i in trie.ends[node]:
                hit = ids[active[rule.linked(overlap, size[active], int(sizes[i]))]]
                hit = hit[query_label[hit] != label[set_ids[i]]]
                if len(hit):
                    yield int(set_ids[i]), hit
            stack += [(c, active, overlap, rest) for c in trie.children[node]]


def chunk_groups(sets: list[np.ndarray], rule: Similarity) -> np.ndarray:
    """For each set the first set of its group of linked ones."""
    label = np.arange(len(sets))
    for i, linked in trie_links(sets, None, rule, label, label):
        old = np.unique(np.append(label[linked], label[i]))
        label[np.isin(label, old)] = old[0]
    return label


# ------------------------------------------------------------------ the join

def _groups(batches, key_columns: int) -> Iterator[list]:
    """Rows of consecutive equal keys, from batches sorted by the key."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:key_columns] != key:
                if rows:
                    yield rows
                key, rows = row[:key_columns], []
            rows.append(row)
    if rows:
        yield rows


def _digests(docs: DataFrame, rule: Similarity) -> DataFrame:
    def run(batch):
        value, bounds = gram_sets(batch.column(1), rule.words)
        sizes = np.diff(bounds)
        nodes = pa.array(node_ids(value, bounds), mask=(sizes == 0) | ~_has_id(batch))
        below = np.concatenate([[0], np.cumsum(value < rule.sampled())])[bounds]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes.astype(np.int64)), nodes, pa.array(np.diff(below))],
                                         names=["doc_id", "n_shingles", "node", "sampled"])
    return map_batches(docs, run, "doc_id bigint, n_shingles bigint, node bigint, sampled bigint")


#: Bits of a node's id that are left out where its n-grams are counted. Nodes equal in the others
#: are counted together, which can only let more sets pass.
_SHORT = 25


def _packed_grams(value: np.ndarray, owner: np.ndarray, nodes: np.ndarray, parts: int) -> pa.RecordBatch:
    """(part, keys, nodes, counted): a batch's n-grams, each once with one of its nodes, by part; and
    in a row of a negative part each node with how many of its n-grams other sets of the batch have."""
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    head = np.ones(len(value), bool)
    head[1:] = value[1:] != value[:-1]
    at = np.flatnonzero(head)
    several = np.diff(np.append(at, len(value))) > 1
    sure = owner[np.repeat(several, np.diff(np.append(at, len(value))))]
    short = nodes.view(U64) >> U64(_SHORT)
    h = mix(value[at] ^ U64(0x2545F4914F6CDD1D))
    part = ((h >> U64(32)) % U64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part, key, of, counted = part[order], h[order].astype(np.uint32), short[owner[at]][order], several[order]
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else at
    ends = np.append(cuts[1:], len(part)) if len(part) else cuts
    packed = (of << U64(1)) | counted.astype(U64)
    low, high = packed.astype(np.uint32), (packed >> U64(32)).astype(np.uint8)
    rows = [(int(part[i]), key[i:j].tobytes(), low[i:j].tobytes(), high[i:j].tobytes())
            for i, j in zip(cuts.tolist(), ends.tolist(), strict=True)]
    if len(sure):
        own, times = np.unique(short[sure], return_counts=True)
        rows.append((-1 - int(own[0] % U64(parts)), own.tobytes(), times.astype(np.int64).tobytes(), b""))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                       *[pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3)]],
                                      names=["part", "keys", "low", "high"])


def _common_in_part(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """(short node, n-grams of it that another set has), not counting those its batch has counted."""
    if rows[0][0] < 0:
        own = np.concatenate([np.frombuffer(r[1], U64) for r in rows])
        times = np.concatenate([np.frombuffer(r[2], np.int64) for r in rows])
        nodes, at = np.unique(own, return_inverse=True)
        return nodes, np.bincount(at, times, len(nodes)).astype(np.int64)
    key = np.concatenate([np.frombuffer(r[1], np.uint32) for r in rows])
    packed = (np.concatenate([np.frombuffer(r[2], np.uint32) for r in rows]).astype(U64)
              | np.concatenate([np.frombuffer(r[3], np.uint8) for r in rows]).astype(U64) << U64(32))
    order = np.lexsort((packed, key))
    key, packed = key[order], packed[order]
    node, counted = packed >> U64(1), (packed & U64(1)).astype(bool)
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(head, len(key)))
    common = (node[head] != node[head + size - 1]) | np.logical_or.reduceat(counted, head)
    again = np.concatenate([[False], (key[1:] == key[:-1]) & (node[1:] == node[:-1])])
    return np.unique(node[np.repeat(common, size) & ~counted & ~again], return_counts=True)


def _hopeful(docs: DataFrame, classes: DataFrame, rule: Similarity, part_grams: int) -> DataFrame:
    """The nodes (node, n_shingles) with enough n-grams that other sets have to be linked at all."""
    total = classes.agg(F.sum("sampled")).first()[0] or 0
    parts = max(1, -(-total // part_grams))

    def dealt(batch):
        value, bounds = gram_sets(batch.column(1), rule.words)
        nodes, sizes = node_ids(value, bounds), np.diff(bounds)
        first = np.zeros(len(sizes), bool)
        first[_first_of_each(nodes, sizes, _has_id(batch))] = True
        owner = np.repeat(np.arange(len(sizes)), sizes)
        use = first[owner] & (value < rule.sampled())
        yield _packed_grams(value[use], owner[use], nodes, parts)

    def count(batches):
        """(to, shorts, times): a part's counts, packed by where each node's are added up."""
        for rows in _groups(batches, 1):
            nodes, times = _common_in_part(rows)
            if not len(nodes):
                continue
            to = (mix(nodes) % U64(parts)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            cuts = np.flatnonzero(np.concatenate([[True], np.diff(to[order]) != 0]))
            own = [order[i:j] for i, j in zip(cuts, [*cuts[1:], len(to)], strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array([int(to[k[0]]) for k in own], pa.int64()), pa.array([nodes[k].tobytes() for k in own], pa.binary()),
                pa.array([times[k].astype(np.int32).tobytes() for k in own], pa.binary())], names=["to", "shorts", "times"])

    def add_up(batches):
        for rows in _groups(batches, 1):
            nodes, at = np.unique(np.concatenate([np.frombuffer(r[1], U64) for r in rows]), return_inverse=True)
            times = np.bincount(at, np.concatenate([np.frombuffer(r[2], np.int32) for r in rows]), len(nodes))
            yield pa.RecordBatch.from_arrays([pa.array(nodes.astype(np.int64)), pa.array(times.astype(np.int64))],
                                             names=["short", "common"])

    common = (map_batches(docs, dealt, "part bigint, keys binary, low binary, high binary")
              .repartition("part").sortWithinPartitions("part").mapInArrow(count, "to bigint, shorts binary, times binary")
              .repartition("to").sortWithinPartitions("to").mapInArrow(add_up, "short bigint, common bigint"))
    needs = F.col("sampled") - F.floor(F.col("n_shingles") * (100 - rule.percent) / 100)
    asked = classes.select("node", "n_shingles", needs.alias("needs"), F.shiftrightunsigned("node", _SHORT).alias("short"))
    return (asked.join(common.hint("merge"), "short", "left").filter(F.coalesce("common", F.lit(0)) >= F.col("needs"))
            .select("node", "n_shingles"))


def segment_keys(value: np.ndarray, bounds: np.ndarray, rule: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit keys, set of each). Two different sets that are linked have a key in common.

    In the scheme of the larger set's bucket, linked sets differ in at most ``differ``
    segments, so they agree in ``segments - differ`` ones. A key stands for a segment with
    all its n-grams. Empty segments have none; a set with so many of them that the agreeing
    ones may all be empty gets one key that all such sets share."""
    sizes = np.diff(bounds)
    keys, owners = [], []
    if not len(value):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    edges = rule.buckets(int(sizes.max()))
    bucket = np.searchsorted(edges, sizes, "right") - 1
    of = np.repeat(np.arange(len(sizes)), sizes)
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(mix(value))])
    for step in (0, 1):  # as the larger set, and as the smaller one
        scheme = bucket + step
        differ = rule.differ(edges[np.minimum(scheme + 1, len(edges) - 1)] - 1)
        segments = ((differ + 4) * 21 + 19) // 20
        used = (differ > 0) & (sizes > 0)  # else only equal sets are linked
        segment = ((value >> U64(32)) * segments[of].astype(U64)) >> U64(32)  # ascending: values are sorted
        head = np.ones(len(value), bool)
        head[1:] = (segment[1:] != segment[:-1]) | (of[1:] != of[:-1])
        at = np.flatnonzero(head)
        total = sums[np.append(at[1:], len(value))] - sums[at]
        where = mix((scheme[of[at]].astype(U64) << U64(32)) | segment[at])
        keep = used[of[at]]
        keys.append(mix(total ^ where)[keep])
        owners.append(of[at][keep])
        filled = np.bincount(of[at], minlength=len(sizes))
        sparse = np.flatnonzero(used & (filled <= differ))
        keys.append(mix(mix(scheme[sparse].astype(U64)) ^ U64(0x5BA25E)))
        owners.append(sparse)
    return np.concatenate(keys), np.concatenate(owners)


#: Rows of _tie_rows.
_TIES = "part bigint, keys binary, nodes binary"


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest number that each of ``n`` is tied to by pairs (a, b), directly or over others."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def _stars(key: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, an owner of each, that of each row's key in the rows' order)."""
    keys, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    return keys, owner[first], owner[first][inverse]


def _tie_rows(value: np.ndarray, bounds: np.ndarray, nodes: np.ndarray, rule: Similarity, parts: int) -> pa.RecordBatch:
    """(part, keys, nodes): each key of these sets once, with the smallest node that its sets are tied
    to here; in rows of negative parts each other node with the smallest one it is tied to."""
    key, owner = segment_keys(value, bounds, rule)
    names, number = np.unique(nodes, return_inverse=True)
    key, centre, tied = _stars(key, number[owner])
    root = forest(number[owner], tied, len(names))
    part = ((mix(key) >> U64(32)) % U64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.append(np.flatnonzero(np.diff(part[order], prepend=-1)), len(key))
    key, centre = key[order], names[root[centre[order]]]
    rows = [(int(part[order[i]]), key[i:j].tobytes(), centre[i:j].tobytes()) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
    apart = np.flatnonzero(root != np.arange(len(names)))
    if len(apart):
        rows.append((-1 - int(mix(names[apart[:1]].view(U64))[0] % U64(parts)), names[apart].tobytes(), names[root[apart]].tobytes()))
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                       *[pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2)]],
                                      names=["part", "keys", "nodes"])


def _joined_ties(rows: DataFrame) -> DataFrame:
    """(a, b): nodes with a common key in a part of the keys, each tied to the smallest."""
    def joined(batches):
        for some in _groups(batches, 1):
            key, node = (np.concatenate([np.frombuffer(r[k], np.int64) for r in some]) for k in (1, 2))
            if some[0][0] < 0:  # pairs already
                names, number = np.unique(np.concatenate([key, node]), return_inverse=True)
                left, right = number[:len(key)], number[len(key):]
            else:
                names, left = np.unique(node, return_inverse=True)
                right = _stars(key, left)[2]
            root = forest(left, right, len(names))
            apart = np.flatnonzero(root != np.arange(len(names)))
            if len(apart):
                yield pa.RecordBatch.from_arrays([pa.array(names[apart]), pa.array(names[root[apart]])], names=["a", "b"])

    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(joined, "a bigint, b bigint")


def _key_parts(nodes: DataFrame, part_grams: int) -> int:
    """Parts for the keys of these nodes: a set has fewer than half as many as it has n-grams, or a few."""
    total = nodes.agg(F.sum(F.col("n_shingles") + 8)).first()[0] or 0
    return max(1, -(-total // max(1, part_grams // 2)))


class NodeFilter:
    """A Bloom filter of one bit a node, sent to every task."""

    def __init__(self, nodes: DataFrame, most_bits: int):
        bits = min(most_bits, 1 << max(16, int(16 * nodes.count()).bit_length()))

        def fill(values, batch):
            h = mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U64))
            at = (h & U64(bits - 1)).astype(np.int64)
            np.bitwise_or.at(values, at >> 3, (1 << (at & 7)).astype(np.uint8))

        found = gather(nodes.select("node").distinct(), bits // 8, "uint8", fill, np.bitwise_or)
        self.bits, self.sent = bits, nodes.sparkSession.sparkContext.broadcast(found)

    def __call__(self, nodes: np.ndarray) -> np.ndarray:
        at = (mix(nodes.view(U64)) & U64(self.bits - 1)).astype(np.int64)
        return (self.sent.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _ties(docs: DataFrame, rule: Similarity, wanted: NodeFilter, parts: int) -> DataFrame:
    def local(batch):
        value, bounds = gram_sets(batch.column(1), rule.words)
        nodes, sizes = node_ids(value, bounds), np.diff(bounds)
        first = _first_of_each(nodes, sizes, _has_id(batch))
        first = first[wanted(nodes[first])]
        part = [value[bounds[i]: bounds[i + 1]] for i in first]
        if part:
            yield _tie_rows(np.concatenate(part), np.cumsum([0, *map(len, part)]), nodes[first], rule, parts)

    return _joined_ties(map_batches(docs, local, _TIES))


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, bounds) of packed sets."""
    parts = [np.frombuffer(x.as_buffer(), U64) for x in column]
    return np.concatenate([np.zeros(0, U64), *parts]), np.cumsum([0] + [len(x) for x in parts])


def _ties_of_sets(sets: DataFrame, rule: Similarity, wanted: NodeFilter | None, parts: int) -> DataFrame:
    def local(batch):
        nodes = batch.column(0).to_numpy()
        some = np.flatnonzero(wanted(nodes)) if wanted else np.arange(len(nodes))
        if len(some):
            value, bounds = _unpacked(batch.column(1).take(pa.array(some)))
            yield _tie_rows(value, bounds, nodes[some], rule, parts)

    return _joined_ties(map_batches(sets.select("node", "grams"), local, _TIES))


def _with_parts(sets: DataFrame, part_grams: int) -> DataFrame:
    """Adds parts, how many its block's n-grams are dealt into. Blocks of several are broadcast, at most one
    for ``part_grams`` n-grams, so the sets stay where they are."""
    parts = sets.groupBy("block").agg(F.ceil(F.sum("n_shingles") / part_grams).cast("bigint").alias("parts"))
    return (sets.join(F.broadcast(parts.filter("parts > 1")), "block", "left")
            .withColumn("parts", F.coalesce("parts", F.lit(1).cast("bigint"))))


def _reaching_in_block(sets: DataFrame, rule: Similarity, part_grams: int) -> DataFrame:
    """The nodes (node, block, n_shingles) with enough n-grams that another set of their block has.

    A block's n-grams are dealt by value into parts of about ``part_grams``, packed: one row
    for each batch, block and part, with four bytes of each n-gram's hash. N-grams equal in
    those are counted as one, which can only let more sets pass."""
    def dealt(batch):
        value, bounds = _unpacked(batch.column(2))
        sizes = np.diff(bounds)
        row = np.repeat(np.arange(len(sizes)), sizes)
        node, block = batch.column(1).to_numpy(), batch.column(0).to_numpy()[row]
        h = mix(value)
        part = (h % batch.column(3).to_numpy()[row].astype(U64)).astype(np.int64)
        order = np.lexsort((row, part, block))
        block, part, row, key = block[order], part[order], row[order], (h[order] >> U64(32)).astype(np.uint32)
        head = np.ones(len(order), bool)
        head[1:] = (block[1:] != block[:-1]) | (part[1:] != part[:-1])
        begin = head.copy()  # of a set within a part
        begin[1:] |= row[1:] != row[:-1]
        begin = np.flatnonzero(begin)
        times = np.diff(np.append(begin, len(order))).astype(np.int32)
        at = np.flatnonzero(head)
        ends = np.append(at[1:], len(order))
        low, high = np.searchsorted(begin, at), np.searchsorted(begin, ends)
        yield pa.RecordBatch.from_arrays([
            pa.array(block[at]), pa.array(part[at]),
            pa.array([key[i:j].tobytes() for i, j in zip(at, ends, strict=True)], pa.binary()),
            pa.array([node[row[begin[i:j]]].tobytes() for i, j in zip(low, high, strict=True)], pa.binary()),
            pa.array([times[i:j].tobytes() for i, j in zip(low, high, strict=True)], pa.binary())],
            names=["block", "part", "keys", "nodes", "times"])

    def count(batches):
        for rows in _groups(batches, 2):
            key = np.concatenate([np.frombuffer(r[2], np.uint32) for r in rows])
            node = np.concatenate([np.repeat(np.frombuffer(r[3], np.int64), np.frombuffer(r[4], np.int32)) for r in rows])
            _, first, times = np.unique(key, return_index=True, return_counts=True)
            nodes, alone = np.unique(node[first[times == 1]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(alone.astype(np.int64))], names=["node", "alone"])

    packed = map_batches(_with_parts(sets, part_grams).select("block", "node", "grams", "parts"),
                         dealt, "block bigint, part bigint, keys binary, nodes binary, times binary")
    alone = (packed.repartition("block", "part").sortWithinPartitions("block", "part")
             .mapInArrow(count, "node bigint, alone bigint").groupBy("node").agg(F.sum("alone").alias("alone")))
    return (sets.select("node", "block", "n_shingles").join(alone.hint("merge"), "node", "left")
            .filter(100 * (F.col("n_shingles") - F.coalesce("alone", F.lit(0))) >= rule.percent * F.col("n_shingles"))
            .drop("alone"))


def _sets_of(docs: DataFrame, wanted: DataFrame, rule: Similarity, bits: int) -> DataFrame:
    """``wanted`` (node, ...) with each node's sorted n-grams as ``grams`` binary."""
    named = NodeFilter(wanted, bits)

    def run(batch):
        value, bounds = gram_sets(batch.column(1), rule.words)
        nodes, sizes = node_ids(value, bounds), np.diff(bounds)
        first = _first_of_each(nodes, sizes, _has_id(batch))
        first = first[named(nodes[first])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[first]), pa.array([value[bounds[i]: bounds[i + 1]].tobytes() for i in first], pa.binary())],
            names=["node", "grams"])

    sets = map_batches(docs, run, "node bigint, grams binary")
    return sets.join(wanted.hint("merge"), "node")


def _chunks(nodes: DataFrame, chunk_nodes: int, chunk_grams: int) -> DataFrame:
    """Adds chunks (how many its block has) and chunk to rows (node, block, n_shingles)."""
    sizes = nodes.groupBy("block").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / chunk_nodes), F.ceil(F.sum("n_shingles") / chunk_grams)).cast("int").alias("chunks"))
    # a row per block of several chunks, at most one for a chunk's nodes or n-grams: a block of very many
    # nodes is not dealt by its key, and sets stay where they are
    return (nodes.join(F.broadcast(sizes.filter("chunks > 1")), "block", "left")
            .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
            .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")))


def _join_chunks(sets: DataFrame, rule: Similarity) -> DataFrame:
    """(node, block, chunks, head): the head is the smallest node of a chunk's linked group."""
    def run(batches):
        for rows in _groups(batches, 2):
            nodes, grams, last = [], [], None
            for _, _, node, _, packed in rows:
                if node != last:
                    nodes.append(node)
                    grams.append(np.frombuffer(packed, U64))
                    last = node
            heads = chunk_groups(grams, rule) if len(nodes) > 1 else np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(nodes, pa.int64()), pa.array([rows[0][0]] * len(nodes), pa.int64()),
                pa.array([rows[0][3]] * len(nodes), pa.int32()), pa.array(np.array(nodes)[heads])],
                names=["node", "block", "chunks", "head"])

    dealt = (sets.select("block", "chunk", "node", "chunks", "grams").repartition("block", "chunk")
             .sortWithinPartitions("block", "chunk", "node"))
    return dealt.mapInArrow(run, "node bigint, block bigint, chunks int, head bigint")


def _cross_chunks(sets: DataFrame, rule: Similarity, chunk_nodes: int, chunk_grams: int) -> DataFrame:
    """(a, b) heads linked across chunks, of blocks that still have several heads.

    ``sets``: (node, block, head, n_shingles, grams). All nodes outside a block's largest
    group are compared with all nodes of the block."""
    by_head = sets.groupBy("block", "head").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("grams"))
    shape = by_head.groupBy("block").agg(
        F.max_by("head", F.struct("n", "head")).alias("largest"), F.sum("n").alias("n"), F.sum("grams").alias("grams"),
        F.max(F.struct("n", "head"))["n"].alias("n_largest"),
        F.max_by("grams", F.struct("n", "head")).alias("grams_largest"))
    pieces = lambda n, g: F.greatest(F.lit(1), F.ceil(n / chunk_nodes), F.ceil(g / chunk_grams)).cast("int")
    shape = shape.select("block", "largest", pieces(F.col("n"), F.col("grams")).alias("cols"),
                         pieces(F.col("n") - F.col("n_largest"), F.col("grams") - F.col("grams_largest")).alias("rows"))
    placed = sets.join(shape, "block")
    one = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    build = placed.select("block", one("cols").alias("col"), all_of("rows").alias("row"), "node", F.lit(False).alias("probe"), "head", "grams")
    probe = (placed.filter("head != largest")
             .select("block", all_of("cols").alias("col"), one("rows").alias("row"), "node", F.lit(True).alias("probe"), "head", "grams"))

    def run(batches):
        for rows in _groups(batches, 3):
            sides: dict[bool, dict] = {False: {}, True: {}}
            for _, _, _, node, probe_side, head, packed in rows:
                sides[probe_side][node] = (head, np.frombuffer(packed, U64))
            if not sides[True] or not sides[False]:
                continue
            label = np.array([h for h, _ in sides[False].values()])
            q_label = np.array([h for h, _ in sides[True].values()])
            found = []
            for i, hits in trie_links([g for _, g in sides[False].values()], [g for _, g in sides[True].values()],
                                      rule, label, q_label):
                old = np.unique(np.append(q_label[hits], label[i]))
                found += [(int(old[0]), int(x)) for x in old[1:]]
                label[np.isin(label, old)] = old[0]
                q_label[np.isin(q_label, old)] = old[0]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                                                  pa.array([f[1] for f in found], pa.int64())], names=["a", "b"])

    dealt = build.union(probe).repartition("block", "col", "row").sortWithinPartitions("block", "col", "row")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def paired_off(key: np.ndarray, node: np.ndarray, head: np.ndarray, size: np.ndarray, rule: Similarity,
               rare: int, held: int = PAIRS_HELD) -> Iterator[tuple[np.ndarray, ...]]:
    """(a, b, n) for pairs of sets of different heads, and of sizes that can be linked, that have n of
    the keys found in at most ``rare`` sets in common: numbers in ``node``'s order, a pair maybe several
    times. One row of key and set for each n-gram of a set; head and size by set."""
    order = np.argsort(key, kind="stable")
    key, node = key[order], node[order]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.append(begin, len(key)))
    for n in range(2, rare + 1):
        lists = begin[times == n]
        left, right = np.triu_indices(n, 1)
        step = max(1, held // len(left))
        for at in range(0, len(lists), step):
            some = lists[at: at + step, None]
            a, b = node[some + left].ravel(), node[some + right].ravel()
            small, large = np.minimum(size[a], size[b]), np.maximum(size[a], size[b])
            open_ = (head[a] != head[b]) & (100 * small >= rule.percent * large)
            a, b = a[open_], b[open_]
            pair, both = np.unique(np.minimum(a, b) * len(size) + np.maximum(a, b), return_counts=True)
            if len(pair):
                yield pair // len(size), pair % len(size), both


_COUNTS = "a bigint, b bigint, a_head bigint, b_head bigint, a_size bigint, b_size bigint, n bigint"


def _rare_counts(sets: DataFrame, rule: Similarity, part_grams: int, rare: int) -> DataFrame:
    """Rows of _COUNTS to be added up: for pairs of a block's sets how many n-grams they share of those
    that at most ``rare`` of its sets have; without b, how many more frequent ones a set has.

    A block's n-grams are dealt by value into parts of about ``part_grams``, packed as one row for
    each batch, block and part."""
    def dealt(batch):
        value, bounds = _unpacked(batch.column(4))
        sizes = np.diff(bounds)
        row = np.repeat(np.arange(len(sizes)), sizes)
        node, block, head = (batch.column(k).to_numpy() for k in (0, 1, 2))
        h = mix(value)
        part = (h % batch.column(5).to_numpy()[row].astype(U64)).astype(np.int64)
        order = np.lexsort((row, part, block[row]))
        part, row, h = part[order], row[order], h[order]
        cuts = np.flatnonzero(np.concatenate([[True], (block[row[1:]] != block[row[:-1]]) | (part[1:] != part[:-1])]))
        out = []
        for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(row)], strict=True):
            own, times = np.unique(row[i:j], return_counts=True)
            out.append((int(block[row[i]]), int(part[i]), h[i:j].tobytes(), times.astype(np.int64).tobytes(),
                        np.stack([node[own], head[own], sizes[own]]).tobytes()))
        yield pa.RecordBatch.from_arrays([*[pa.array([r[k] for r in out], pa.int64()) for k in (0, 1)],
                                          *[pa.array([r[k] for r in out], pa.binary()) for k in (2, 3, 4)]],
                                         names=["block", "part", "keys", "times", "sets"])

    def rows(*columns):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[x.split()[0] for x in _COUNTS.split(", ")])

    def count(batches):
        for some in _groups(batches, 2):
            key = np.concatenate([np.frombuffer(r[2], U64) for r in some])
            times = np.concatenate([np.frombuffer(r[3], np.int64) for r in some])
            node, head, size = np.concatenate([np.frombuffer(r[4], np.int64).reshape(3, -1) for r in some], axis=1)
            of = np.repeat(np.arange(len(node)), times)
            _, at, found = np.unique(key, return_inverse=True, return_counts=True)
            own, n = np.unique(of[found[at] > rare], return_counts=True)
            nothing = [None] * len(own)
            yield rows(node[own], nothing, head[own], nothing, size[own], nothing, n)
            for a, b, n in paired_off(key, of, head, size, rule, rare):
                yield rows(node[a], node[b], head[a], head[b], size[a], size[b], n)

    packed = map_batches(_with_parts(sets, part_grams).select("node", "block", "head", "n_shingles", "grams", "parts"), dealt,
                         "block bigint, part bigint, keys binary, times binary, sets binary")
    return (packed.repartition("block", "part").sortWithinPartitions("block", "part").mapInArrow(count, _COUNTS))


def _compared(pairs: DataFrame, sets: DataFrame, rule: Similarity) -> DataFrame:
    """(a, b): the heads of those pairs (a, b, a_head, b_head) that are linked."""
    def run(batch):
        a, b = (batch.column(k).to_numpy() for k in (0, 1))
        grams = [[np.frombuffer(x.as_buffer(), U64) for x in batch.column(k)] for k in (2, 3)]
        linked = [rule.linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)) for x, y in zip(*grams, strict=True)]
        some = np.flatnonzero(linked)
        yield pa.RecordBatch.from_arrays([pa.array(a[some]), pa.array(b[some])], names=["a", "b"])

    def of(side):
        return sets.select(F.col("node").alias(side), F.col("grams").alias(f"{side}_grams")).hint("merge")

    both = pairs.join(of("a"), "a").join(of("b"), "b").select("a_head", "b_head", "a_grams", "b_grams")
    return map_batches(both, run, "a bigint, b bigint")


def _links_apart(sets: DataFrame, rule: Similarity, chunk_nodes: int, chunk_grams: int, part_grams: int,
                 rare: int = RARE_SETS) -> DataFrame:
    """(a, b) linked heads of blocks that still have several heads; ``sets``: (node, block, head, n_shingles, grams).

    Linked sets share at least ``percent`` of the larger one's n-grams. Two that share no rare one
    are both frequent, that is, so much of each is found in more than ``rare`` sets of the block."""
    counts = checkpoint(_rare_counts(sets, rule, part_grams, rare))
    many = counts.filter("b is null").groupBy("a", "a_size").agg(F.sum("n").alias("n"))
    frequent = 100 * F.col("n") >= rule.percent * F.col("a_size")
    side = lambda x: many.select(F.col("a").alias(x), F.col("n").alias(f"{x}_n"), frequent.alias(f"{x}_frequent")).hint("merge")
    pairs = counts.filter("b is not null").groupBy("a", "b", "a_head", "b_head", "a_size", "b_size").agg(F.sum("n").alias("n"))
    more = F.least(F.coalesce("a_n", F.lit(0)), F.coalesce("b_n", F.lit(0)))
    linked = lambda both: rule.linked(both, F.col("a_size"), F.col("b_size"))
    pairs = checkpoint(pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").filter(linked(F.col("n") + more))
                       .withColumn("sure", linked(F.col("n"))))
    sure = pairs.filter("sure").select(F.col("a_head").alias("a"), F.col("b_head").alias("b"))
    unsure = pairs.filter(~F.col("sure") & ~(F.coalesce("a_frequent", F.lit(False)) & F.coalesce("b_frequent", F.lit(False))))
    links = sure.union(_compared(unsure.select("a", "b", "a_head", "b_head"), sets, rule))
    some = checkpoint(sets.join(many.filter(frequent).select(F.col("a").alias("node")).hint("merge"), "node", "left_semi"))
    if some.isEmpty():
        return links
    blocks = components(_ties_of_sets(some, rule, None, _key_parts(some, part_grams))).withColumnRenamed("component", "block")
    blocks = some.select("node", "head").join(blocks.hint("merge"), "node")
    several = blocks.groupBy("block").agg(F.min("head").alias("lo"), F.max("head").alias("hi")).filter("lo != hi").select("block")
    some = some.drop("block").join(blocks.select("node", "block").join(several.hint("merge"), "block", "left_semi").hint("merge"), "node")
    return links.union(_cross_chunks(checkpoint(some), rule, chunk_nodes, chunk_grams))


SETS = ("node", "block", "n_shingles", "grams")


def _large_blocks(sets: DataFrame, rule: Similarity, bits: int, chunk_nodes: int, chunk_grams: int, part_grams: int,
                  rounds: int = 3) -> DataFrame:
    """(node, root) of linked nodes among blocks of several chunks; ``sets`` has SETS."""
    left = sets.count()
    for _ in range(rounds):  # each round is exact; a further one would only save comparisons
        stay = checkpoint(_reaching_in_block(sets, rule, chunk_grams))
        before, left = left, stay.count()
        if not left:
            return sets.select("node", F.col("node").alias("root")).limit(0)
        grams = sets.select("node", "grams")
        if left > 0.9 * before:  # hardly a block would fall apart
            sets = checkpoint(grams.join(stay.hint("merge"), "node").select(*SETS))
            break
        ties = _ties_of_sets(sets, rule, NodeFilter(stay, bits), _key_parts(stay, part_grams))
        blocks = components(ties).withColumnRenamed("component", "block")
        stay = stay.drop("block").join(blocks.hint("merge"), "node")
        sets = checkpoint(grams.join(stay.hint("merge"), "node").select(*SETS))
    first = checkpoint(_join_chunks(_chunks(sets, chunk_nodes, chunk_grams), rule))
    # the chunks' group heads among each other
    several = first.filter("chunks > 1")
    done = first.filter("chunks = 1").select("node", F.col("head").alias("root"))
    if several.isEmpty():
        return done
    heads = sets.join(several.select(F.col("head").alias("node")).distinct().hint("merge"), "node", "left_semi")
    second = checkpoint(_join_chunks(_chunks(heads, chunk_nodes, chunk_grams), rule))
    merged = several.join(second.select(F.col("node").alias("head"), F.col("head").alias("root")).hint("merge"), "head")
    merged = checkpoint(merged.select("node", "block", F.col("root").alias("head")))
    open_blocks = (merged.groupBy("block").agg(F.min("head").alias("lo"), F.max("head").alias("hi"))
                   .filter("lo != hi").select("block"))
    apart = merged.join(open_blocks.hint("merge"), "block", "left_semi")
    if apart.isEmpty():
        return done.union(merged.select("node", F.col("head").alias("root")))
    apart = sets.join(apart.select("node", "head").hint("merge"), "node").select("node", "block", "head", "n_shingles", "grams")
    across = components(_links_apart(checkpoint(apart), rule, chunk_nodes, chunk_grams, part_grams))
    joined = merged.join(across.select(F.col("node").alias("head"), "component").hint("merge"), "head", "left")
    return done.union(joined.select("node", F.coalesce("component", "head").alias("root")))


def _linked_nodes(docs: DataFrame, classes: DataFrame, rule: Similarity, bits: int, chunk_nodes: int, chunk_grams: int,
                  part_grams: int) -> DataFrame:
    """(node, root) of nodes in blocks; a node that is not listed is linked with nothing."""
    hopeful = checkpoint(_hopeful(docs, classes, rule, part_grams))
    ties = _ties(docs, rule, NodeFilter(hopeful, bits), _key_parts(hopeful, part_grams))
    blocks = components(ties).withColumnRenamed("component", "block")
    sized = checkpoint(_chunks(blocks.join(classes.select("node", "n_shingles").hint("merge"), "node"), chunk_nodes, chunk_grams))
    sets = checkpoint(_sets_of(docs, sized, rule, bits).select(*SETS, "chunks", "chunk").dropDuplicates(["node"]))
    small = _join_chunks(sets.filter("chunks = 1"), rule).select("node", F.col("head").alias("root"))
    large = sets.filter("chunks > 1").select(*SETS)
    if large.isEmpty():
        return small
    return small.union(_large_blocks(large, rule, bits, chunk_nodes, chunk_grams, part_grams))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Similarity = Similarity(),
                    filter_bits: int = FILTER_BITS, chunk_nodes: int = CHUNK_NODES, chunk_grams: int = CHUNK_GRAMS,
                    part_grams: int = PART_GRAMS) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; the id is the smallest one reachable."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    each = checkpoint(_digests(rows, rule))
    classes = checkpoint(each.filter("node is not null").groupBy("node")
                         .agg(F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n_shingles"),
                              F.max("sampled").alias("sampled")))
    roots = checkpoint(_linked_nodes(rows, classes, rule, filter_bits, chunk_nodes, chunk_grams, part_grams))
    named = roots.join(classes.select("node", "first_id").hint("merge"), "node")
    lowest = named.groupBy("root").agg(F.min("first_id").alias("lowest"))
    linked = named.join(lowest.hint("merge"), "root").select("node", "lowest")
    ids = (classes.join(linked.hint("merge"), "node", "left")
           .select("node", F.coalesce("lowest", "first_id").alias("component_id")))
    has = each.filter("node is not null").join(ids.hint("merge"), "node").select("doc_id", "n_shingles", "component_id")
    rest = each.filter("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return has.union(rest)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     rule: Similarity = Similarity()) -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns.

    Rows with a null id stay; rows repeated under one id stay together."""
    goes = (near_duplicates(docs, id_col, text_col, rule).filter("component_id != doc_id")
            .select(F.col("doc_id").alias("__gone")))
    return docs.join(goes, F.col(id_col).cast("bigint") == F.col("__gone"), "left_anti")
