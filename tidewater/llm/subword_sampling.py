"""SentencePiece encoding with distinct sampled segmentations, and decoding.

A text is its bytes with every space written as the piece mark and one mark in front. Its
lattice has the vocabulary's pieces as edges between character starts; characters without a
piece fall back to byte pieces. Pieces never reach from a word into the next one, so equal
words share one small lattice, kept by the worker. A piece weighs ``1 / (rank + 1) ** exponent`` by its
place in the vocabulary (a Zipf prior; nothing is trained).

Gumbel top-k without replacement: the whole lattice's perturbed log-probability is drawn
first, the first sample goes down from it by ancestral choice. Every other edge along a
sample's path leads to a part of the lattice whose mass is known, hence whose best perturbed
value can be drawn below the path's own. The next sample is the best such part: a best-first
(A*) search whose bounds are exact, so samples are distinct and come in falling order. The
value of the first one not taken gives each sample its inclusion probability.

All random numbers are hashes of (seed, row key, purpose, sample, word, place in the word): none is
drawn twice, however long a word is, and a row's samples don't depend on its batch or on
retries. Per-row work only, no shuffle.

Defined results: null text is empty and gives one segmentation without pieces; a text with
fewer than k segmentations gives all of them, the score of which is then 1; repeated rows
get equal samples; a null key counts as key 0 and is returned as null; other columns are ignored.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import map_batches
from ._text import U64, SpanHash, mix

MARK = "▁".encode()
#: Stands for the mark itself in a text, so that decoding tells it from a space; the byte is
#: in no UTF-8 text and is encoded by its byte piece.
OWN_MARK = b"\xff"


class Vocabulary:
    """Pieces of a SentencePiece model, by the hash of their bytes."""

    _loaded: dict[tuple[str, float], "Vocabulary"] = {}

    def __init__(self, path: str, exponent: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes: list[bytes] = []
        usable, self.byte_id = [], np.zeros(256, np.int64)
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes.append(bytes([int(piece[3:5], 16)]))
                self.byte_id[int(piece[3:5], 16)] = i
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes.append(b"")
            else:
                own = piece.encode()
                self.bytes.append(own)
                if MARK not in own.lstrip(MARK) and own:  # within one word
                    usable.append(i)
        self.weight = -exponent * np.log(np.arange(len(self.bytes)) + 1.0)
        self.weight[self.byte_id] = -exponent * np.log(len(self.bytes))
        self._grow_tree(np.array(usable, np.int64))
        sizes = np.array([len(b) for b in self.bytes])
        self.spelling = np.frombuffer(b"".join(self.bytes) or b"\0", np.uint8), np.cumsum([0, *sizes])[:-1], sizes

    def _grow_tree(self, usable: np.ndarray) -> None:
        """The pieces as a tree of bytes: ``child`` has a row for each inner node, the root's first, with
        the next node by byte or -1; ``piece_of`` has the piece that ends at a node, or -1."""
        sizes = np.array([len(self.bytes[i]) for i in usable], np.int64)
        data = np.frombuffer(b"".join(self.bytes[i] for i in usable) or b"\0", np.uint8)
        begin = np.cumsum(sizes) - sizes
        node = np.zeros(len(usable), np.int64)
        parents, bytes_, ends, n = [], [], [], 1
        for depth in range(int(sizes.max(initial=0))):
            at = np.flatnonzero(sizes > depth)
            step, inverse = np.unique(node[at] << 8 | data[begin[at] + depth], return_inverse=True)
            parents.append(step >> 8)
            bytes_.append(step & 255)
            node[at] = n + inverse
            n += len(step)
            done = at[sizes[at] == depth + 1]
            ends.append((node[done], usable[done]))
        parent = np.concatenate([np.zeros(0, np.int64), *parents])
        inner = np.zeros(n, bool)
        inner[0] = True
        inner[parent] = True
        self.n_inner = int(inner.sum())
        number = np.where(inner, np.cumsum(inner) - 1, self.n_inner + np.cumsum(~inner) - 1)
        self.child = np.full((self.n_inner, 256), -1, np.int32)
        self.child[number[parent], np.concatenate([np.zeros(0, np.int64), *bytes_])] = number[1:]
        self.piece_of = np.full(n, -1, np.int32)
        for at, piece in ends:
            self.piece_of[number[at]] = piece

    def pieces_at(self, data: np.ndarray, begins: np.ndarray, room: np.ndarray, char: np.ndarray):
        """(source, length, piece) of every piece that spells bytes from a place on, up to a character's start."""
        source, lengths, piece = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        node, length = np.zeros(len(begins), np.int64), 0
        while len(begins):
            node = self.child[node, data[begins + length]]
            length += 1
            found = self.piece_of[node]  # of node -1 too, which is dropped next
            hit = np.flatnonzero((node >= 0) & (found >= 0) & char[begins + length])
            source.append(begins[hit])
            lengths.append(np.full(len(hit), length))
            piece.append(found[hit])
            on = np.flatnonzero((node >= 0) & (node < self.n_inner) & (room > length))
            node, begins, room = node[on], begins[on], room[on]
        return np.concatenate(source), np.concatenate(lengths), np.concatenate(piece)

    def spelled(self, ids: np.ndarray) -> bytes:
        """The bytes of pieces in a row."""
        pool, begin, size = self.spelling
        total = np.concatenate([[0], np.cumsum(size[ids])])
        return pool[np.repeat(begin[ids] - total[:-1], size[ids]) + np.arange(total[-1])].tobytes()

    def lattices(self) -> "Lattices":
        """The worker's lattices, without those met once only when they have grown too large."""
        if self._lattices is None:
            self._lattices = Lattices(self)
        if self._lattices.states[0].n > KEPT_STATES:
            self._lattices.forget()
        return self._lattices

    _lattices: "Lattices | None" = None

    @classmethod
    def load(cls, path: str, exponent: float) -> "Vocabulary":
        if (path, exponent) not in cls._loaded:
            cls._loaded[path, exponent] = cls(path, exponent)
        return cls._loaded[path, exponent]

    def decode(self, ids) -> str:
        raw = b"".join(self.bytes[i] for i in ids)
        return raw[len(MARK):].replace(MARK, b" ").replace(OWN_MARK, MARK).decode("utf-8", "replace")


class Grown:
    """An array that is added to at its end."""

    def __init__(self, dtype):
        self.held, self.n = np.zeros(1 << 12, dtype), 0

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.held):
            old = self.held[: self.n]
            self.held = np.zeros(1 << int(self.n + len(values) - 1).bit_length(), old.dtype)  # untouched memory costs nothing
            self.held[: self.n] = old
        self.held[self.n: self.n + len(values)] = values
        self.n += len(values)

    def keep(self, chosen: np.ndarray) -> None:
        """Only the values at these places stay."""
        self.held[: len(chosen)] = self.held[chosen]
        self.n = len(chosen)


class Numbered:
    """Numbers by distinct 64-bit hashes: open addressing, at most half full."""

    def __init__(self):
        self.n, self.keys, self.number = 0, np.zeros(1 << 16, U64), np.full(1 << 16, -1, np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        last = U64(len(self.keys) - 1)
        slot = keys & last
        while len(todo):
            found = self.number[slot]
            hit = self.keys[slot] == keys[todo]
            hit &= found >= 0
            out[todo[hit]] = found[hit]
            on = np.flatnonzero((found >= 0) & ~hit)
            todo, slot = todo[on], (slot[on] + U64(1)) & last
        return out

    def put(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        """Adds distinct keys that are not held."""
        if 2 * (self.n + len(keys)) > len(self.keys):
            held = np.flatnonzero(self.number >= 0)
            keys, numbers = np.concatenate([self.keys[held], keys]), np.concatenate([self.number[held], numbers])
            size = 1 << int(4 * len(keys) - 1).bit_length()
            self.n, self.keys, self.number = 0, np.zeros(size, U64), np.full(size, -1, np.int64)
        self.n += len(keys)
        last = U64(len(self.keys) - 1)
        slot = keys & last
        while len(keys):
            free = np.flatnonzero(self.number[slot] < 0)
            self.number[slot[free]] = numbers[free]  # of several the last
            won = np.zeros(len(keys), bool)
            won[free] = self.number[slot[free]] == numbers[free]
            self.keys[slot[won]] = keys[won]
            keys, numbers, slot = keys[~won], numbers[~won], (slot[~won] + U64(1)) & last


#: States of the lattices a worker keeps; beyond it the words met in one batch only are forgotten, which costs time only.
KEPT_STATES = 3_000_000
#: Bytes of text taken at a time: a byte takes hundreds while its text is worked on.
BATCH_BYTES = 250_000


class Lattices:
    """The lattices of all words met so far; a state is a byte place within a word. A state's edges
    lie together, ``summed`` adds up their probabilities from the first on."""

    def __init__(self, vocabulary: "Vocabulary"):
        self.vocabulary, self.known = vocabulary, Numbered()
        self.words = [Grown(np.int64), Grown(np.int64), Grown(bool), Grown(U64)]  # start, end, met again, hash
        self.states = [Grown(np.int64), Grown(np.int32)]                      # first edge, number of edges
        self.edges = [Grown(np.int32), Grown(np.int32), Grown(np.int32), Grown(np.float64), Grown(np.float64)]

    def numbers(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Word numbers of 64-bit word hashes; the words are spans of ``data``, where marks are spaces."""
        out = self.known.get(keys)
        new = np.flatnonzero(out < 0)
        self.words[2].held[out[out >= 0]] = True
        if len(new):
            names, at, inverse = np.unique(keys[new], return_index=True, return_inverse=True)
            numbers = self.words[0].n + np.arange(len(names))
            out[new] = numbers[inverse]
            self.known.put(names, numbers)
            self.words[3].add(names)
            self._add(data, starts[new[at]], ends[new[at]])
        self.start, self.end = (g.held for g in self.words[:2])
        self.first, self.count = (g.held for g in self.states)
        self.source, self.target, self.piece, self.log_p, self.summed = (g.held for g in self.edges)
        return out

    def forget(self) -> None:
        """Keeps the words met again, or nothing if they alone are too many."""
        start, end, again, _ = (g.held[: g.n] for g in self.words)
        kept = np.flatnonzero(again)
        size = end[kept] + 1 - start[kept]
        if 2 * size.sum() > KEPT_STATES:
            kept, size = kept[:0], size[:0]
        to = np.cumsum(size) - size
        shift = start[kept] - to
        states = np.repeat(shift, size) + np.arange(int(size.sum()))
        first, count = (g.held[states] for g in self.states)
        begin = np.cumsum(count, dtype=np.int64) - count
        edges = np.repeat(first - begin, count) + np.arange(int(count.sum()))
        for grown in self.edges:
            grown.keep(edges)
        for grown in self.edges[:2]:  # source and target are states
            grown.held[: grown.n] -= np.repeat(np.repeat(shift, size), count)
        for grown in self.states:
            grown.keep(states)
        self.states[0].held[: len(begin)] = begin
        for grown in self.words:
            grown.keep(kept)
        self.words[0].held[: len(kept)], self.words[1].held[: len(kept)] = to, to + size - 1
        self.words[2].held[: len(kept)] = False  # must be met anew
        self.known = Numbered()
        self.known.put(self.words[3].held[: len(kept)], np.arange(len(kept)))

    def p(self, edges: np.ndarray) -> np.ndarray:
        return np.exp(self.log_p[edges])

    def _add(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        vocabulary = self.vocabulary
        data, sizes = spelled_apart(data, starts, ends)
        start = np.cumsum(sizes) - sizes
        end = start + sizes - 1
        n = len(data)
        char = ((data & 0xC0) != 0x80)
        last = np.zeros(n, bool)
        last[end] = True
        room = np.repeat(end, sizes) - np.arange(n)  # bytes left in the word
        chars = np.flatnonzero(char)
        begun = ~last[chars]
        begins, stop = chars[begun], np.append(chars[1:], n)[begun]
        source, length, piece = vocabulary.pieces_at(data, begins, room[begins], char)
        target = source + length
        # a character without a piece of its own: its bytes, one edge each
        stop_of = np.zeros(n, np.int64)
        stop_of[begins] = stop
        whole = np.zeros(n, bool)
        whole[source[target == stop_of[source]]] = True
        bare = ~whole[begins]
        size = (stop - begins)[bare]
        places = np.repeat(begins[bare] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        source = np.concatenate([source, places])
        target = np.concatenate([target, places + 1])
        piece = np.concatenate([piece, vocabulary.byte_id[data[places]]])
        order = np.argsort(source, kind="stable")
        source, target, piece = source[order], target[order], piece[order]
        first = np.concatenate([[0], np.cumsum(np.bincount(source, minlength=n))])
        beta = np.full(n, -np.inf)
        beta[end] = 0.0
        weight = vocabulary.weight[piece]
        far = room[source]
        small = far.astype(np.uint16) if len(far) and far.max() < 1 << 16 else far  # sorted by digits
        by = np.argsort(small, kind="stable")
        cuts = np.cumsum(np.bincount(far, minlength=1))
        by_source, by_target, by_weight = source[by], target[by], weight[by]
        heads = np.flatnonzero(np.append(True, by_source[1:] != by_source[:-1])) if len(by) else by  # of states
        head_cuts, cuts, by_source = np.searchsorted(heads, cuts).tolist(), cuts.tolist(), by_source[heads]
        for d in range(len(cuts) - 1):
            a, b = cuts[d], cuts[d + 1]
            if a < b:
                value = by_weight[a:b] + beta[by_target[a:b]]
                own = slice(head_cuts[d], head_cuts[d + 1])
                beta[by_source[own]] = np.logaddexp.reduceat(value, heads[own] - a)
        with np.errstate(invalid="ignore"):
            log_p = weight + beta[target] - beta[source]
        log_p[~np.isfinite(log_p)] = -np.inf
        p = np.exp(log_p)
        # sums within each state, added one edge at a time, so they don't depend on other words
        summed, count = p.copy(), np.diff(first)
        heads, rest, k = first[:-1], count, 1
        while len(heads):
            more = np.flatnonzero(rest > k)
            heads, rest = heads[more], rest[more]
            summed[heads + k] += summed[heads + k - 1]
            k += 1
        n_states, n_edges = self.states[0].n, self.edges[0].n
        for grown, values in zip((*self.words[:3], *self.states, *self.edges),
                                 (start + n_states, end + n_states, np.zeros(len(start), bool), first[:-1] + n_edges, count, source + n_states,
                                  target + n_states, piece, log_p, summed), strict=True):
            grown.add(values)

    def choose(self, state: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge out of each state, by its probability: the first whose sum passes the draw."""
        edge, last = self.first[state], self.count[state] - 1
        last += edge
        wanted = u * self.summed[last]
        step = (1 << int((last - edge).max(initial=0)).bit_length()) >> 1
        while step:
            some = np.flatnonzero(last - edge >= step)
            some = some[self.summed[edge[some] + (step - 1)] <= wanted[some]]
            edge[some] += step
            step >>= 1
        return edge


#: What a random number is for.
ROOT, WALK, PARTS, BRANCH = range(1, 5)


def _drawn(h: np.ndarray) -> np.ndarray:
    return ((h >> U64(11)).astype(float) + 0.5) * 2.0 ** -53


def _lane(key: np.ndarray, purpose: int, sample: int, place: np.ndarray, of: np.ndarray | slice = slice(None)) -> np.ndarray:
    """What the draws of one row, purpose, sample and place begin from; ``of``: the row of each place."""
    return mix(mix(key ^ mix(np.array([(sample << 3) | purpose], np.int64).view(U64)))[of] + place.astype(U64))


def _uniform(key: np.ndarray, purpose: int, sample: int, place: np.ndarray, of: np.ndarray | slice = slice(None)) -> np.ndarray:
    return _drawn(mix(_lane(key, purpose, sample, place, of)))


def _walk(lattice: Lattices, state: np.ndarray, word: np.ndarray, key: np.ndarray, place: np.ndarray, sample: int):
    """Samples each word from its state to its end: (item of each edge, edges), in order."""
    steps, count = [], np.zeros(len(state), np.int64)
    alive = np.flatnonzero(state < lattice.end[word])
    at, stop = state[alive], lattice.end[word][alive]
    lane = (_lane(key, WALK, sample, place) - lattice.start[word].astype(U64))[alive]
    while len(alive):
        e = lattice.choose(at, _drawn(mix(lane + at.astype(U64))))
        steps.append((alive, e))
        count[alive] += 1
        at = lattice.target[e].astype(np.int64)
        on = np.flatnonzero(at < stop)
        alive, at, stop, lane = alive[on], at[on], stop[on], lane[on]
    first = np.cumsum(count) - count
    edge = np.zeros(int(count.sum()), np.int64)
    for k, (some, e) in enumerate(steps):
        edge[first[some] + k] = e
    return np.repeat(np.arange(len(count)), count), edge


def _below(mass: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values with these log masses, given that they are below their bounds."""
    with np.errstate(divide="ignore", over="ignore"):
        return mass - np.log(np.exp(np.minimum(mass - bound, 700)) - np.log(u))


def marked(text: str | None) -> bytes:
    """The text's bytes with a space in front, its own marks by their stand-in; spaces are marks."""
    return b" " + text.encode().replace(MARK, OWN_MARK) if text else b""


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where words begin: at every text and at a space behind another character."""
    cut = data == 32
    cut[1:] &= data[:-1] != 32
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(cut)


def spelled_apart(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some words, a zero behind each, spaces as marks; and their sizes with that zero."""
    size = ends - starts
    first = np.cumsum(size) - size
    own = data[np.repeat(starts - first, size) + np.arange(int(size.sum()))]
    space = own == 32
    wide = np.where(space, len(MARK), 1)
    at = np.cumsum(wide) - wide + np.repeat(np.arange(len(size)), size)
    sizes = np.add.reduceat(wide, first) + 1
    out = np.zeros(int(sizes.sum()), np.uint8)
    out[at] = own
    for k, byte in enumerate(MARK):
        out[at[space] + k] = byte
    return out, sizes


def split_words(text: bytes) -> list[bytes]:
    """The words of one text, with marks."""
    raw = marked(text.decode("utf-8", "replace"))
    data = np.frombuffer(raw, np.uint8)
    starts = word_starts(data, np.array([0, len(raw)])).tolist()
    return [raw[a:b].replace(b" ", MARK) for a, b in zip(starts, [*starts[1:], len(raw)], strict=True)]


def sample_texts(texts: list[str | None], keys: list[int | None], vocabulary: Vocabulary, k: int, seed: int = 0):
    """For each text up to k tuples (ids, log-probability, perturbed value, inclusion)."""
    raws = [marked(t) for t in texts]
    raw = b"".join(raws)
    n = len(texts)
    row_key = mix(np.array([key or 0 for key in keys], np.int64).view(U64) ^ mix(np.full(n, seed, np.int64).view(U64)))
    root = -np.log(-np.log(_uniform(row_key, ROOT, 0, np.zeros(n, np.int64))))
    if not raw:
        return [[(np.zeros(0, np.int64), 0.0, float(value), 1.0)] for value in root]
    data = np.frombuffer(raw, np.uint8)
    offsets = np.cumsum([0, *map(len, raws)])
    starts = word_starts(data, offsets)
    ends = np.append(starts[1:], len(data))
    lattice = vocabulary.lattices()
    word = lattice.numbers(SpanHash(data)(starts, ends), data, starts, ends)
    first = np.searchsorted(starts, offsets).tolist()
    size = np.diff(first)
    doc = np.repeat(np.arange(n), size)
    place = np.arange(len(word)) - np.array(first)[:-1][doc]
    item, edge = _walk(lattice, lattice.start[word], word, row_key[doc], place, 0)
    cut = np.searchsorted(doc[item], np.arange(n + 1)) if len(item) else np.zeros(n + 1, np.int64)
    # per text: paths [edges, word place of each edge, value], open parts [value, path, step]
    paths = [[] for _ in range(n)]
    opened: list[list] = [[] for _ in range(n)]
    taken: list[dict] = [{} for _ in range(n)]
    # log-probabilities of each path added up, and the path that the newest one left
    sums: list[list[np.ndarray]] = [[] for _ in range(n)]
    parents = [0] * n

    def open_parts(newest: list[tuple[int, int]], sample: int) -> None:
        """Draws the best value of every part that leaves the newest path of a text from a step on."""
        if not newest:
            return
        texts_of = np.array([i for i, _ in newest])
        own = [paths[i][-1] for i in texts_of]
        since = np.array([max(at, 0) for _, at in newest])
        sizes = np.array([len(x[0]) for x in own]) - since
        begin = np.cumsum(sizes) - sizes
        edges, of = np.concatenate([x[0][at:] for x, at in zip(own, since.tolist(), strict=True)]), np.repeat(np.arange(len(own)), sizes)
        log_p = lattice.log_p[edges]
        prefix = -log_p  # added up text by text: sums over others would round differently
        for b, size_of, (i, left) in zip(begin.tolist(), sizes.tolist(), newest, strict=True):
            own_p = log_p[b: b + size_of]
            before = sums[i][parents[i]][:left] if left > 0 else own_p[:0]
            total = np.cumsum(np.concatenate([before[-1:], own_p]))[len(before[-1:]):]
            prefix[b: b + size_of] += total
            sums[i].append(np.concatenate([before, total]))
        other = 1 - np.exp(log_p)
        step = np.arange(len(edges)) - begin[of] + since[of]
        for b, (i, at) in enumerate(newest):
            if at >= 0 and (used := taken[i].get(_node(i, at))) is not None:
                other[begin[b]] = 1 - lattice.p(np.array(sorted(used))).sum()
        at = np.flatnonzero(other > 1e-12)  # a state's only edge leaves exactly nothing
        of, step = of[at], step[at]
        g = _below(prefix[at] + np.log(other[at]), np.array([x[2] for x in own])[of],
                   _uniform(row_key[texts_of], PARTS, sample, step, of))
        first_of = np.searchsorted(of, np.arange(len(own) + 1)).tolist()
        for b, i in enumerate(texts_of.tolist()):
            mine = g[first_of[b]: first_of[b + 1]]
            # no more than k parts of a path can be wanted
            best = np.flatnonzero(mine >= np.partition(mine, -k)[-k]) if len(mine) > k else np.arange(len(mine))
            best = best[np.argsort(-mine[best], kind="stable")][:k] + first_of[b]
            opened[i] += [(float(g[x]), len(paths[i]) - 1, int(step[x])) for x in best]

    def _node(i: int, step: int):
        return (paths[i][-1][0][:step].tobytes(), step)

    place_of = place[item]
    for i in range(n):
        paths[i].append((edge[cut[i]: cut[i + 1]], place_of[cut[i]: cut[i + 1]], float(root[i])))
    open_parts([(i, -1) for i in range(n) if k > 0 and size[i]], 0)
    for sample in range(1, k):
        branch, draws = [], _uniform(row_key, BRANCH, sample, np.zeros(n, np.int64)).tolist()
        for i in range(n):
            if not opened[i]:
                continue
            best = max(range(len(opened[i])), key=lambda x: opened[i][x][0])
            value, path, step = opened[i].pop(best)
            edges, at_place, _ = paths[i][path]
            node = (edges[:step].tobytes(), step)
            used = taken[i].setdefault(node, {int(edges[step])})
            state = int(lattice.source[edges[step]])
            out = [e for e in range(lattice.first[state], lattice.first[state] + lattice.count[state]) if e not in used]
            p = np.cumsum(lattice.p(np.array(out)))
            e = out[min(int(np.searchsorted(p, draws[i] * p[-1], "right")), len(out) - 1)]
            used.add(e)
            parents[i] = path
            branch.append((i, path, step, e, value))
        if not branch:
            break
        # what is left of each branch: the rest of its word, then the words behind it
        starts, their_word, their_key, their_place, owner = [], [], [], [], []
        for b, (i, path, step, e, _) in enumerate(branch):
            at = int(paths[i][path][1][step])
            rest = word[first[i] + at: first[i + 1]]
            begin = lattice.start[rest]
            begin[0] = lattice.target[e]
            starts.append(begin)
            their_word.append(rest)
            their_key.append(np.full(len(rest), row_key[i]))
            their_place.append(np.arange(at, at + len(rest)))
            owner.append(np.full(len(rest), b))
        owner, their_place = np.concatenate(owner), np.concatenate(their_place)
        item, edge = _walk(lattice, np.concatenate(starts), np.concatenate(their_word), np.concatenate(their_key), their_place, sample)
        cut = np.searchsorted(owner[item], np.arange(len(branch) + 1))
        for b, (i, path, step, e, value) in enumerate(branch):
            edges, at_place, _ = paths[i][path]
            own = slice(cut[b], cut[b + 1])
            paths[i].append((np.concatenate([edges[:step], [e], edge[own]]),
                             np.concatenate([at_place[: step + 1], their_place[item[own]]]), value))
        open_parts([(i, step) for i, _, step, _, _ in branch], sample)
    out = []
    for i in range(n):
        limit = max((x[0] for x in opened[i]), default=None)
        rows = []
        for edges, _, value in paths[i][:k]:
            log_p = float(lattice.log_p[edges].sum())
            inclusion = 1.0 if limit is None else float(-np.expm1(-np.exp(log_p - limit)))
            rows.append((lattice.piece[edges], log_p, value, inclusion))
        out.append(rows)
    return out


def sample_segmentations(docs: DataFrame, model_path: str, k: int = 2, exponent: float = 1.0, seed: int = 0,
                         id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True,
                         key: Column | None = None) -> DataFrame:
    """doc_id, sample, n_pieces, log_prob, perturbed, inclusion, ids_crc32, round_trip and,
    if wanted, ids. ``key``: what seeds a row, where that is not its id."""
    def run(batch):
        vocabulary = Vocabulary.load(model_path, exponent)
        texts = batch.column(1).to_pylist()
        sampled = sample_texts(texts, batch.column(2).to_pylist(), vocabulary, k, seed)
        whole = np.concatenate([np.zeros(0, np.int64), *(ids for samples in sampled for ids, *_ in samples)])
        spelled, ends = vocabulary.spelled(whole), np.concatenate([[0], np.cumsum(vocabulary.spelling[2][whole])])
        rows, at, begin = [], 0, 0
        for i, (text, samples) in enumerate(zip(texts, sampled, strict=True)):
            want = marked(text).replace(b" ", MARK)
            for r, (ids, log_p, value, inclusion) in enumerate(samples):
                at += len(ids)
                end = int(ends[at])
                rows.append((i, r, len(ids), log_p, value, inclusion, zlib.crc32(ids.astype("<u4").tobytes()),
                             spelled[begin:end] == want, ids))
                begin = end
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 9
        arrays = [batch.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                  pa.array(cols[3], pa.float64()), pa.array(cols[4], pa.float64()), pa.array(cols[5], pa.float64()),
                  pa.array(cols[6], pa.int64()), pa.array(cols[7], pa.bool_())]
        if keep_ids:
            flat = np.concatenate([np.zeros(0, np.int32), *cols[8]]).astype(np.int32)
            bounds = np.cumsum([0, *cols[2]]).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)))
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = ("doc_id bigint, sample int, n_pieces bigint, log_prob double, perturbed double, inclusion double, "
              "ids_crc32 bigint, round_trip boolean" + (", ids array<int>" if keep_ids else ""))
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    own = F.col(id_col).cast("bigint")
    rows = docs.select(own.alias("id"), F.col(text_col).cast("string").alias("text"), (own if key is None else key).alias("key"))
    return map_batches(rows, run, schema, BATCH_BYTES)
