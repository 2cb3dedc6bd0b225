"""The n-gram join against all pairs."""
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidewater.llm import ngram_join as j
from tidewater.llm.components import components

SCHEMA = "doc_id bigint, text string, node bigint"


def grams(text, words):
    w = [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())


def closed(ids, pairs):
    """Smallest id reachable from each id."""
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def plain(rows, words=4, percent=85):
    """Candidates by any shared gram; pairs are tested on the whole sets."""
    sets = {i: grams(t, words) for i, t in rows}
    at = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            at[g].append(i)
    seen, pairs = set(), []
    for own in at.values():
        for k, a in enumerate(own):
            for b in own[k + 1:]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                        pairs.append((a, b))
    root = closed(list(sets), pairs)
    return sorted((i, len(sets[i]), root[i]) for i in sets)


def edited(r, words, edits):
    w = list(words)
    for _ in range(edits):
        w[r.randrange(len(w))] = f"e{r.randrange(10 ** 6)}"
    return " ".join(w)


def family_rows(seed, families=12, members=25):
    r = random.Random(seed)
    rows = []
    for f in range(families):
        base = [f"w{r.randrange(400)}" for _ in range(r.choice([6, 30, 120, 300]))]
        for _ in range(r.randint(1, members)):
            rows.append(edited(r, base, r.randint(0, max(1, len(base) // 40))))
    rows += ["", None, " \n ", "one", "One", "one two", "one two three", "ONE two three four", "a b c d e", "A b C d e"]
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,nodes,cap", [(1, 1000, 300_000), (2, 5, 300_000), (3, 7, 900)])
def test_families(spark, seed, nodes, cap):
    rows = family_rows(seed)
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], SCHEMA).repartition(6)
    got = j.near_duplicates(df, chunk_nodes=nodes, chunk_grams=cap, part_grams=5 * cap // 300)
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_a_chain_across_chunks(spark):
    """Each text is linked with the next only, so the chunks' heads alone would not meet."""
    words = [f"c{i}" for i in range(260)]
    rows = [(i, " ".join(words[2 * i: 2 * i + 60])) for i in range(100)]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], SCHEMA)
    got = j.near_duplicates(df, chunk_nodes=9)
    assert sorted(map(tuple, got.collect())) == plain(rows)


def test_sets_apart_are_not_sent_to_every_chunk(spark, monkeypatch):
    """Texts of passages that two or three share form one block of several chunks; they are paired off
    by these passages, not compared with all others."""
    r = random.Random(8)
    passages = [[f"p{k}x{i}" for i in range(30)] for k in range(90)]
    rows = []
    for i in range(120):
        rows.append(" ".join(w for k in r.sample(range(90), 4) for w in passages[k]))
    rows += [edited(r, rows[i].split(" "), 1) for i in range(0, 120, 6)]
    rows = list(enumerate(rows))
    sent, cross = [], j._cross_chunks
    monkeypatch.setattr(j, "_cross_chunks", lambda sets, *a: sent.append(sets.count()) or cross(sets, *a))
    paired, apart = [], j._rare_counts
    monkeypatch.setattr(j, "_rare_counts", lambda sets, *a: paired.append(sets.count()) or apart(sets, *a))
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], SCHEMA)
    got = j.near_duplicates(df, chunk_nodes=7, rule=j.Similarity(5, 60))
    assert sorted(map(tuple, got.collect())) == plain(rows, 5, 60)
    assert sum(paired) > 50 and sum(sent) == 0


@pytest.mark.parametrize("seed,rare", [(1, 64), (2, 3), (3, 2)])
def test_links_apart_against_all_pairs(spark, seed, rare):
    """With few rare n-grams, with many, and with sets that have hardly any."""
    r = np.random.default_rng(seed)
    rule, rows, node = j.Similarity(5, 80), [], 100
    for block in range(3):
        common = r.integers(0, 1 << 63, 40, dtype=np.uint64)
        for _ in range(12):
            base = np.append(r.integers(0, 1 << 63, int(r.integers(1, 60)), dtype=np.uint64), r.permutation(common)[: int(r.integers(0, 41))])
            for _ in range(int(r.integers(1, 7))):
                kept = r.permutation(base)[: max(1, len(base) - int(r.integers(0, len(base) // 6 + 1)))]
                s = np.unique(np.append(kept, r.integers(0, 1 << 63, int(r.integers(0, len(base) // 12 + 1)), dtype=np.uint64)))
                node += int(r.integers(1, 5))
                rows.append((node, block, node if r.random() < 0.7 or not rows or rows[-1][1] != block else rows[-1][2], len(s), bytearray(s.tobytes())))
    df = spark.createDataFrame(rows, "node bigint, block bigint, head bigint, n_shingles bigint, grams binary").repartition(4)
    sets = {x[0]: set(np.frombuffer(bytes(x[4]), np.uint64).tolist()) for x in rows}
    links = [(a[2], b[2]) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1]
             and rule.linked(len(sets[a[0]] & sets[b[0]]), a[3], b[3])]
    heads = {x[2] for x in rows}
    got = [tuple(x) for x in j._links_apart(df, rule, 6, 300_000, 50, rare).collect()]
    assert closed(heads, got) == closed(heads, links) and any(a != b for a, b in links)


def test_spans_in_order_are_hashed_in_parts(monkeypatch):
    from tidewater.llm import _text
    r, held, whole = np.random.default_rng(2), [], _text.SpanHash
    data = r.integers(0, 256, 5000).astype(np.uint8)
    starts = np.sort(r.integers(0, 5000, 400))
    ends = np.minimum(starts + r.integers(0, 90, 400), 5000)
    want = whole(data)(starts, ends)
    monkeypatch.setattr(_text, "SpanHash", lambda data: held.append(len(data)) or whole(data))
    monkeypatch.setattr(_text, "SUMMED_BYTES", 300)
    assert (_text.span_hashes(data, starts, ends) == want).all() and max(held) < 400
    order = r.permutation(400)
    assert (_text.span_hashes(data, starts[order], ends[order]) == want[order]).all()
    assert len(_text.span_hashes(data, starts[:0], ends[:0])) == 0


def test_gram_sets_of_a_batch_are_hashed_in_parts(monkeypatch):
    r, seen, part = random.Random(6), [], j._gram_sets
    texts = [None if i % 9 == 0 else " ".join(f"w{r.randrange(50)}" for _ in range(r.randrange(40))) for i in range(200)]
    want = part(pa.array(texts), 3)
    monkeypatch.setattr(j, "HASHED_BYTES", 700)
    monkeypatch.setattr(j, "_gram_sets", lambda column, words: seen.append(column.nbytes) or part(column, words))
    for column, skip in ((pa.array(texts), 0), (pa.array(["cut off", *texts]).slice(1), 0), (pa.array([], pa.string()), 200)):
        value, bounds = j.gram_sets(column, 3)
        assert len(bounds) == 201 - skip and (skip or (value == want[0]).all() and (bounds == want[1]).all())
    assert len(seen) > 20


@pytest.mark.parametrize("held", [1, 50, 10 ** 6])
def test_paired_off(held):
    r = np.random.default_rng(held)
    rule, sets = j.Similarity(5, 60), [np.unique(r.integers(0, 60, int(r.integers(1, 30)))) for _ in range(40)]
    head, size = r.integers(0, 20, 40), np.array([len(s) for s in sets])
    key, node = np.concatenate(sets).astype(np.uint64), np.repeat(np.arange(40), size)
    times = np.bincount(np.concatenate(sets), minlength=60)
    got, want = defaultdict(int), {}
    for a, b, n in j.paired_off(key, node, head, size, rule, 11, held):
        for x, y, z in zip(a.tolist(), b.tolist(), n.tolist()):
            got[x, y] += z
    for a in range(40):
        for b in range(a + 1, 40):
            n = sum(times[x] <= 11 for x in set(sets[a].tolist()) & set(sets[b].tolist()))
            if n and head[a] != head[b] and 100 * min(size[a], size[b]) >= 60 * max(size[a], size[b]):
                want[a, b] = n
    assert got == want and want


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = plain(rows)
    assert sorted(map(tuple, j.near_duplicates(docs).collect())) == want
    kept = {r.doc_id for r in j.drop_near_copies(docs).select("doc_id").collect()}
    assert kept == {i for i, _, c in want if i == c}


def test_null_ids_repeated_rows_and_empty_table(spark):
    text = " ".join(f"z{i}" for i in range(50))
    df = spark.createDataFrame([(3, text, 0), (3, text, 0), (None, text, 0), (2, text + " more", 0), (9, None, 0)], SCHEMA)
    got = sorted(map(str, map(tuple, j.near_duplicates(df).collect())))
    assert got == sorted(map(str, [(3, 47, 2), (3, 47, 2), (None, 47, None), (2, 48, 2), (9, 0, 9)]))
    assert sorted(str(r.doc_id) for r in j.drop_near_copies(df).collect()) == ["2", "9", "None"]
    assert j.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(25))
def test_trie_links_every_pair(seed):
    r = random.Random(seed)
    base = [r.sample(range(60), r.randint(1, 25)) for _ in range(4)]
    sets = []
    for _ in range(r.randint(1, 60)):
        s = set(r.choice(base))
        for _ in range(r.randint(0, 3)):
            s ^= {r.randrange(70)}
        sets.append(np.array(sorted(s or {1}), np.uint64))
    rule = j.Similarity(4, r.choice([60, 85]))
    lab, q_lab = np.arange(len(sets)), -1 - np.arange(len(sets))
    got = {(i, int(q)) for i, hits in j.trie_links(sets, r.choice([sets, None]), rule, lab, q_lab, matrix_bytes=r.choice([100, 10 ** 6])) for q in hits if i != q}
    want = {(a, b) for a in range(len(sets)) for b in range(len(sets))
            if a != b and rule.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))}
    assert got == want


@pytest.mark.parametrize("seed", range(40))
def test_linked_sets_share_a_segment_key(seed):
    r = np.random.default_rng(seed)
    rule = j.Similarity(4, int(r.choice([80, 85, 90])))
    sets = []
    for n in (1, 2, 3, 6, 7, 8, 9, 12, 20, 40, 90, 300):
        base = r.integers(0, 1 << 63, n, dtype=np.uint64) * 2 + 1
        sets.append(np.unique(base))
        for _ in range(12):
            edits = int(r.integers(0, n // 5 + 2))
            kept = r.permutation(base)[: max(1, n - int(r.integers(0, edits + 1)))]
            sets.append(np.unique(np.concatenate([kept, r.integers(0, 1 << 63, int(r.integers(0, edits + 1)), dtype=np.uint64)])))
    value, bounds = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets])
    key, owner = j.segment_keys(value, bounds, rule)
    own = [set(key[owner == i].tolist()) for i in range(len(sets))]
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if rule.linked(both, len(sets[a]), len(sets[b])) and both < max(len(sets[a]), len(sets[b])):
                assert own[a] & own[b]


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    want = closed({x for e in edges if e[0] != e[1] for x in e}, [e for e in edges if e[0] != e[1]])
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert sorted(map(tuple, got.collect())) == sorted(want.items())
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_forest():
    r = np.random.default_rng(3)
    a, b = r.integers(0, 400, 250), r.integers(0, 400, 250)
    a, b = np.append(a, np.arange(400, 499)), np.append(b, np.arange(401, 500))  # and a chain
    want = closed(range(500), zip(a.tolist(), b.tolist()))
    assert j.forest(a, b, 500).tolist() == [want[i] for i in range(500)]


def test_near_copies_are_tied_once_each():
    """A slice of n near copies sends a row for each part of its keys and a tie for each copy."""
    r = np.random.default_rng(4)
    base = r.integers(0, 1 << 63, 400, dtype=np.uint64)
    sets = [np.unique(np.append(base[r.permutation(400)[:395]], r.integers(0, 1 << 63, 3, dtype=np.uint64))) for _ in range(60)]
    nodes, parts = r.integers(-(1 << 62), 1 << 62, 60), 3
    rows = j._tie_rows(np.concatenate(sets), np.cumsum([0, *map(len, sets)]), nodes, j.Similarity(), parts).to_pylist()
    assert len(rows) == parts + 1
    ties = [x for x in rows if x["part"] < 0]
    assert sorted(np.frombuffer(ties[0]["keys"], np.int64)) == sorted(set(nodes.tolist()) - {nodes.min()})
    for x in rows:
        assert set(np.frombuffer(x["nodes"], np.int64)) == {nodes.min()}


@pytest.mark.parametrize("seed", range(30))
def test_linked_sets_stay_hopeful(seed):
    """Counted in batches and parts, a linked set has as many common n-grams as it needs."""
    r = np.random.default_rng(seed)
    rule = j.Similarity(4, int(r.choice([80, 85, 90])))
    sets = []
    for n in (1, 3, 7, 20, 90, 300):
        base = r.integers(0, 1 << 63, n, dtype=np.uint64) * 2 + 1
        for _ in range(5):
            drop = int(r.integers(0, n // 5 + 1))
            new = r.integers(0, 1 << 63, int(r.integers(0, n // 8 + 1)), dtype=np.uint64)
            sets.append(np.unique(np.concatenate([r.permutation(base)[: n - drop], new])))
        sets.append(np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * 2 + 1))  # like no other
    sets = list({s.tobytes(): s for s in sets}.values())
    nodes = r.integers(-(1 << 62), 1 << 62, len(sets))
    parts, rows = int(r.integers(1, 9)), []
    deal = np.array_split(r.permutation(len(sets)), 3)
    for own in [*deal, deal[0]]:  # one batch's sets are copies of another's
        value = np.concatenate([sets[i] for i in own])
        owner = np.repeat(own, [len(sets[i]) for i in own])
        use = value < rule.sampled()
        rows += zip(*(c.to_pylist() for c in j._packed_grams(value[use], owner[use], nodes, parts).columns))
    common = defaultdict(int)
    for part in {x[0] for x in rows}:
        for node, times in zip(*j._common_in_part([x for x in rows if x[0] == part])):
            common[int(node)] += int(times)
    alone = 0
    for a, s in enumerate(sets):
        has = common[int(nodes[a].view(np.uint64) >> np.uint64(j._SHORT))]
        others = np.concatenate([x for b, x in enumerate(sets) if b != a])
        sampled = s[s < rule.sampled()]
        assert has >= int(np.isin(sampled, others).sum())
        hopeful = has >= len(sampled) - rule.missing(len(s))
        alone += not hopeful
        if any(rule.linked(len(np.intersect1d(s, x)), len(s), len(x)) for b, x in enumerate(sets) if b != a):
            assert hopeful
    assert alone
