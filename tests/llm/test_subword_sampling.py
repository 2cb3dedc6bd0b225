"""Subword sampling: round trips, distinct samples, and their distribution against all segmentations."""
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tidewater.llm import subword_sampling as s

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "   ", "a", " a  b ", "the cat", "é😀ü\n\t日本", "x" * 3000, "tail \n", "▁ mark ▁▁", "\x00\x01", "ab" * 200 + " end"]


@pytest.fixture(scope="module")
def vocabulary():
    return s.Vocabulary.load(PATH, 1.0)


def all_segmentations(text, vocabulary):
    """{ids: probability} of a short text."""
    known = {}
    for i, b in enumerate(vocabulary.bytes):
        if b and i not in set(vocabulary.byte_id.tolist()) and s.MARK not in b.lstrip(s.MARK):
            known[b] = i
    parts = [()]
    weights = [0.0]
    for word in s.split_words(text.encode()):
        ways = []

        def go(at, ids, w, word=word, ways=ways):
            if at == len(word):
                ways.append((ids, w))
            for stop in range(at + 1, len(word) + 1):
                if word[at:stop] in known:
                    i = known[word[at:stop]]
                    go(stop, (*ids, i), w + vocabulary.weight[i])
        go(0, (), 0.0)
        parts, weights = ([a + b for a in parts for b, _ in ways], [x + y for x in weights for _, y in ways])
    total = sum(map(math.exp, weights))
    return {p: math.exp(w) / total for p, w in zip(parts, weights, strict=True)}


def test_round_trip_and_order(vocabulary):
    out = s.sample_texts(ODD, list(range(len(ODD))), vocabulary, 4)
    for text, rows in zip(ODD, out, strict=True):
        assert all(vocabulary.decode(ids.tolist()) == (text or "") for ids, *_ in rows)
        assert len({tuple(r[0].tolist()) for r in rows}) == len(rows)
        assert [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True)
        assert all(0 <= r[3] <= 1 for r in rows)


def test_samples_do_not_depend_on_the_batch(vocabulary):
    a = s.sample_texts(["one two three", "four"], [7, 8], vocabulary, 3)
    b = s.sample_texts(["four", "zzz", "one two three"], [8, 1, 7], vocabulary, 3)
    for x, y in zip(a, [b[2], b[0]], strict=True):
        assert [r[0].tolist() for r in x] == [r[0].tolist() for r in y]


def test_log_probabilities(vocabulary):
    for text in ("the", "a cat", "hi"):
        want = all_segmentations(text, vocabulary)
        rows = s.sample_texts([text], [3], vocabulary, 50)[0]
        assert len(rows) == min(50, len(want))
        for ids, log_p, _, _ in rows:
            assert math.isclose(math.exp(log_p), want[tuple(ids.tolist())], rel_tol=1e-9)
        if len(want) <= 50:
            assert all(r[3] == 1.0 for r in rows)


def test_distribution(vocabulary):
    """First samples follow the probabilities; pairs follow sampling without replacement."""
    text, n = "the", 6000
    want = all_segmentations(text, vocabulary)
    out = s.sample_texts([text] * n, list(range(n)), vocabulary, 2)
    first, second = Counter(tuple(r[0][0].tolist()) for r in out), Counter(tuple(r[1][0].tolist()) for r in out)
    for ids, p in want.items():
        assert abs(first[ids] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3
        q = sum(o * p / (1 - o) for other, o in want.items() if other != ids)
        assert abs(second[ids] / n - q) < 5 * math.sqrt(q * (1 - q) / n) + 1e-3


def test_inclusion_estimates_are_unbiased(vocabulary):
    """Horvitz-Thompson weights p / inclusion add up to about one."""
    out = s.sample_texts(["hello there"] * 3000, list(range(3000)), vocabulary, 3)
    assert abs(np.mean([sum(math.exp(r[1]) / r[3] for r in rows) for rows in out]) - 1) < 0.05


def test_on_spark(spark):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ODD)] + [(None, "x y", 1), (4, "a", 2)],
                               "doc_id bigint, text string, sample int")
    rows = s.sample_segmentations(df, PATH, k=3).collect()
    assert all(r.round_trip for r in rows) and len({r.doc_id for r in rows}) == len(ODD) + 1
    one = [(r.sample, r.ids) for r in rows if r.doc_id == 4]
    assert one[: len(one) // 2] == one[len(one) // 2:]
    assert s.sample_segmentations(df.limit(0), PATH).count() == 0


def test_query_takes_every_document_and_turn(spark):
    from tidewater.llm.queries import op5_sentencepiece
    sf = "/root/testdata/sf0.001"
    got = op5_sentencepiece(spark, sf).filter("sample = 0").select("input", "doc_id", "round_trip").collect()
    docs = [("documents", r.doc_id) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    turns = [("conversations", r.conv_id * 1_000_000 + r.turn) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    assert sorted((r.input, r.doc_id) for r in got) == sorted(docs + turns)
    assert all(r.round_trip for r in got)


def test_long_words_draw_anew_at_every_place(vocabulary):
    """A word of some 10,000 pieces: equal stretches of it are not cut alike, and its pieces are as
    frequent as in many short words."""
    out = s.sample_texts(["internationalisation" * 4000], [5], vocabulary, 1)[0][0][0]
    assert len(out) > 10_000
    lengths = [len(vocabulary.bytes[i]) for i in out]
    halves = [Counter(lengths[: len(lengths) // 2]), Counter(lengths[len(lengths) // 2:])]
    for n in set(lengths):
        a, b = (h[n] / sum(h.values()) for h in halves)
        assert abs(a - b) < 6 * math.sqrt(max(a, b) / sum(halves[0].values())) + 1e-3
    ends = np.cumsum(lengths) - len(s.MARK)
    cuts = Counter()
    for k in range(4000):  # where each repeat of the stretch is cut
        own = ends[np.searchsorted(ends, 20 * k): np.searchsorted(ends, 20 * k + 20)] - 20 * k
        cuts[tuple(own.tolist())] += 1
    assert len(cuts) > 10
    assert out[:2000].tolist() != out[4096:6096].tolist()


def test_kept_lattices_change_nothing(vocabulary, monkeypatch):
    texts = [f"word{i % 7} other{i} thing, {i}" for i in range(200)]
    a = s.sample_texts(texts, list(range(200)), vocabulary, 3)
    monkeypatch.setattr(s, "KEPT_STATES", 0)  # afresh each time
    b = [s.sample_texts([t], [i], vocabulary, 3)[0] for i, t in enumerate(texts)]
    for x, y in zip(a, b, strict=True):
        assert [(r[0].tolist(), r[1:]) for r in x] == [(r[0].tolist(), r[1:]) for r in y]


def test_turns_with_large_ids(spark):
    rows = [(1 << 62, 5, "one text"), (1 << 62, 6, "one text"), (None, 1, "x")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, text string")
    from pyspark.sql import functions as F
    got = s.sample_segmentations(df, PATH, id_col="turn", key=F.xxhash64("conv_id", "turn")).collect()
    own = {r.doc_id: r.perturbed for r in got if r.sample == 0}
    assert len(own) == 3 and own[5] != own[6]


def test_spark_batches_are_small(spark):
    """A task holds a multiple of the text it takes at a time, so that is bounded."""
    from tidewater.llm._spark import map_batches

    docs = spark.range(0, 60, 1, 1).selectExpr("id", "repeat('abcdefghi ', 2000) AS text")
    sizes = [r["n"] for r in map_batches(docs, lambda b: iter([b.append_column("n", b.column(0)).select(["n"]).slice(0, 1)]),
                                         "n bigint", s.BATCH_BYTES).collect()]
    assert len(sizes) == 5  # twelve texts each


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_parts_are_the_best_of_each_text(vocabulary, k):
    """Samples of many texts, in falling order, equal those of each text alone."""
    texts = ["a", "", None, "the cat sat on the mat", "x" * 40, "Ünïcode änd ▁ marks", "word " * 30]
    together = s.sample_texts(texts, list(range(len(texts))), vocabulary, k, 4)
    for i, text in enumerate(texts):
        alone = s.sample_texts([text], [i], vocabulary, k, 4)[0]
        assert [(x[0].tolist(), *x[1:]) for x in alone] == [(x[0].tolist(), *x[1:]) for x in together[i]]
        assert [x[2] for x in alone] == sorted((x[2] for x in alone), reverse=True)
        assert len({x[0].tobytes() for x in alone}) == len(alone) <= k


def test_tree_finds_every_piece(vocabulary):
    """Pieces at every place of some words, against slices looked up among all spellings."""
    known = {b: i for i, b in enumerate(vocabulary.bytes) if b and s.MARK not in b.lstrip(s.MARK) and i not in vocabulary.byte_id.tolist()}
    words = ["the", "internationalisation", "änd", "日本語", "x" * 50, "\x00a", "été."]
    data = np.frombuffer(b"".join(s.MARK + w.encode() + b"\0" for w in words), np.uint8)
    ends = np.cumsum([len(s.MARK + w.encode()) + 1 for w in words]) - 1
    char = (data & 0xC0) != 0x80
    begins = np.setdiff1d(np.flatnonzero(char), ends)
    room = ends[np.searchsorted(ends, begins)] - begins
    got = list(zip(*(x.tolist() for x in vocabulary.pieces_at(data, begins, room, char)), strict=True))
    want = [(a, n, known[data[a: a + n].tobytes()]) for a, r in zip(begins.tolist(), room.tolist(), strict=True)
            for n in range(1, r + 1) if char[a + n] and data[a: a + n].tobytes() in known]
    assert got == sorted(want, key=lambda x: (x[1], x[0])) and len(want) > 50


def test_words_met_again_are_kept(monkeypatch):
    """A full memory forgets the words of one batch only; common words are not built anew."""
    own = s.Vocabulary(PATH, 1.0)
    monkeypatch.setattr(s, "KEPT_STATES", 1500)
    common = ["the common words of  many texts, é日本"]
    a = s.sample_texts(common, [3], own, 3)
    s.sample_texts(common, [4], own, 3)
    s.sample_texts([" ".join(f"seldom{k}word" for k in range(120))], [9], own, 3)
    assert own._lattices.states[0].n > 1500
    built = []
    monkeypatch.setattr(own, "pieces_at", lambda *x: built.append(x) or s.Vocabulary.pieces_at(own, *x))
    b = s.sample_texts(common, [3], own, 3)
    assert not built and own._lattices.states[0].n < 100
    for x, y in zip(a[0], b[0], strict=True):
        assert x[0].tolist() == y[0].tolist() and x[1:] == y[1:]
    # many batches with other words between, against a memory of one batch
    texts = [f"{common[0]} word{i % 9} other{i}" for i in range(300)]
    kept = [s.sample_texts(texts[i: i + 10], list(range(i, i + 10)), own, 3) for i in range(0, 300, 10)]
    monkeypatch.setattr(s, "KEPT_STATES", 0)
    for i, x in enumerate(x for some in kept for x in some):
        for p, q in zip(x, s.sample_texts([texts[i]], [i], own, 3)[0], strict=True):
            assert p[0].tolist() == q[0].tolist() and p[1:] == q[1:]
