"""Toxicity: exact neighbours against all cosines, and held-out accuracy."""
import random

import numpy as np
import pyarrow as pa
import pytest

from tidewater.llm import toxicity as t
from tidewater.llm.queries import op9_toxicity


@pytest.mark.parametrize("seed", range(8))
def test_nearest_is_exact(seed):
    r = random.Random(seed)
    n_terms = 20
    index = t.Index.build(np.arange(n_terms, dtype=np.uint64), np.array([r.uniform(1, 5) for _ in range(n_terms)]), [], [], [], [], 0.1)
    draw = lambda: {r.randrange(n_terms): r.randint(1, 5) for _ in range(r.randint(1, 6))}
    vectors = [index.vector(draw()) for _ in range(700)]
    full = t.Index.build(index.terms, index.idf, vectors, [1] * 700, [0] * 700, list(range(700)), 0.1)
    dense = np.zeros((700, n_terms))
    for i, v in enumerate(vectors):
        for k, w in v.items():
            dense[i, k] = w
    for _ in range(30):
        q = index.vector(draw())
        cosines = dense @ np.array([q.get(k, 0.0) for k in range(n_terms)])
        best = [i for i in np.lexsort((np.arange(700), -cosines.round(12))) if cosines[i] > 1e-12][:15]
        ids, found = full.nearest(q)
        assert np.allclose(found, cosines[best]) and set(ids[found > found[-1] + 1e-9]) <= set(best)


def test_terms():
    found, doc, _ = t.text_terms(pa.array(["Idiot idiots, ÉÉ", None, "", "straßenbahn 12", "ééééx"]))
    assert len(found[doc == 0]) == 3 + 1 + 2 and len(found[doc == 3]) == 1 + 4 and set(doc) == {0, 3, 4}
    both, _, _ = t.text_terms(pa.array(["idiot"]))
    assert set(both) <= set(found) and (doc == 4).sum() == 2


def test_isotonic_is_monotone():
    x, y = t.isotonic(np.array([.1, .2, .3, .9]), np.array([0., 3., 1., 9.]), np.array([10., 10., 10., 10.]))
    assert (np.diff(y) >= 0).all() and (np.diff(x) > 0).all()


def test_held_out(spark):
    rows = op9_toxicity(spark, "/root/testdata/sf0.1").collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    out = [r for r in rows if r.held_out and r.doc_id in toxic]
    caught = sum(r.predicted for r in out if toxic[r.doc_id])
    wrong = sum(r.predicted for r in out if not toxic[r.doc_id])
    positives = sum(toxic[r.doc_id] for r in out)
    assert caught >= 0.85 * positives and wrong <= 0.03 * len(out)
    assert [r for r in out if r.predicted][0].evidence


def test_odd_rows(spark):
    # equal texts count once as evidence, so every example has a word of its own
    own = lambda i: "".join(chr(97 + int(d)) for d in f"{i:04d}")
    rows = ([(i, f"plain words q{own(i)} here", "x") for i in range(60)]
            + [(100 + i, f"you are an idiot and scum q{own(100 + i)}", "x") for i in range(40)])
    odd = [(500, None, "x"), (501, "", "x"), (None, "idiot", "x"), (100, "you are an idiot", "x")]
    df = spark.createDataFrame(rows + odd, "doc_id bigint, text string, toxic string")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _, _ in rows] + [(3, 0), (None, 1), (77777, 1), (5, None)],
                                   "doc_id bigint, toxic int")
    index = t.fit(df, labels)
    got = t.score_documents(df, index).collect()
    assert len(got) == len(rows) + 4
    assert {r.predicted for r in got if r.doc_id and 100 <= r.doc_id < 500} == {1}
    assert {r.predicted for r in got if r.doc_id is not None and (r.doc_id < 100 or r.doc_id >= 500)} == {0}
    none = t.fit(df, labels.limit(0))
    assert {r.score for r in t.score_documents(df, none).collect()} == {0.0}
    assert t.score_documents(df.limit(0), index).count() == 0
    assert t.fit(df.limit(0), labels).empty_rate == 0.0


def test_texts_without_telling_words_are_searched_by_all_their_words(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("bcdfgklmnprst") for _ in range(6))
    alone = [[word() for _ in range(30)] for _ in range(300)]  # nothing here tells the toxic ones apart
    toxic = {i: int(i % 10 == 0) for i in range(300)}
    near = [w[:25] + [word() for _ in range(5)] for w in alone]
    rows = [(i, " ".join(w)) for i, w in enumerate(alone)] + [(1000 + i, " ".join(w)) for i, w in enumerate(near)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    index = t.fit(df, spark.createDataFrame(list(toxic.items()), "doc_id bigint, toxic int"))
    assert len(index.terms) == len({w for x in alone for w in x})
    got = {x.doc_id: x for x in t.score_documents(df, index).collect()}
    assert all(got[1000 + i].evidence[0] == i for i in toxic)
    assert min(got[1000 + i].score for i in toxic if toxic[i]) > max(got[1000 + i].score for i in toxic if not toxic[i])


def test_vectors_hold_every_word_of_the_examples(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    index = t.fit(docs, labels)
    texts = {x.doc_id: x.text for x in docs.collect()}
    marked = {x.doc_id for x in labels.filter("toxic is not null").collect()} & set(texts)
    counts = {i: _plain_words(texts[i]) for i in texts}
    words = {w for i in marked for w in counts[i]}
    assert set(np.unique(t.text_terms(pa.array(sorted(words)))[0][:len(words)])) == set(index.terms[:index.n_words])
    number = {w: int(np.searchsorted(index.terms[:index.n_words], t.text_terms(pa.array([w]))[0][0])) for w in words}
    first, place, count = t._counts(pa.array(list(texts.values())), index.terms, index.n_words)
    for k, i in enumerate(texts):
        own = dict(zip(place[first[k]: first[k + 1]].tolist(), count[first[k]: first[k + 1]].tolist(), strict=True))
        plain = {number[w]: n for w, n in counts[i].items() if w in words}
        other = sum(n for w, n in counts[i].items() if w not in words)
        assert {p: n for p, n in own.items() if p < index.n_words} == plain
        assert own.get(len(index.terms), 0) == other


def _plain_words(text):
    import re
    from collections import Counter
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return Counter(re.findall(r"[a-z\u0080-\U0010ffff]+", lowered))


def test_each_index_keeps_its_own_results():
    import pickle
    one, other = (t.Index.build(np.zeros(0, np.uint64), np.ones(1), [], [], [], [], 0.0) for _ in range(2))
    one.cache["key"] = 1
    assert one.cache == {"key": 1} and other.cache == {} and pickle.loads(pickle.dumps(one)).cache == {}
    assert not hasattr(t, "_CACHE")


def test_places_of_hashes_and_of_crowded_terms():
    r = np.random.default_rng(5)
    for terms in (r.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2), np.arange(500, dtype=np.uint64),
                  np.array([7], np.uint64), np.array([0, (1 << 64) - 1], np.uint64)):
        terms = np.unique(terms)
        found = np.concatenate([terms, terms + np.uint64(1), r.integers(0, 1 << 63, 5000, dtype=np.uint64)])
        number = {x: i for i, x in enumerate(terms.tolist())}
        for low, high in ((0, len(terms)), (len(terms) // 2, len(terms)), (0, 0)):
            want = [i if low <= (i := number.get(x, -1)) < high else -1 for x in found.tolist()]
            assert t._places(found, terms, low, high).tolist() == want
    hashes = np.unique(r.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2))
    assert t._by_first_bits(hashes, hashes).tolist() == list(range(len(hashes)))
    assert t._by_first_bits(hashes, np.arange(500, dtype=np.uint64)) is None


def test_a_vector_without_postings_has_no_neighbours():
    index = t.Index.build(np.arange(3, dtype=np.uint64), np.ones(4), [{0: 1.0}, {1: 1.0}], [1, 1], [0, 1], [1, 2], 0.5)
    assert [len(x) for x in index.nearest({2: 1.0})] == [0, 0]
    assert [len(x) for x in index.nearest({})] == [0, 0]
    assert index.nearest({1: 1.0})[0].tolist() == [1]
