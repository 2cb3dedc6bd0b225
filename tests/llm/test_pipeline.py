"""The corpus pipeline, stage by stage and whole, against plain Python on a small fixture."""
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as c
from tidewater.llm.queries import tokenizer_file

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def shingles(text, k=5):
    w = text.lower().split()
    return {tuple(w[i: i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a and b else 0.0


def prose(r, sentences=12):
    """Clean lines of sentences of invented words."""
    def word():
        return "".join(r.choice("bdfgklmnprstv") + r.choice("aeiou") for _ in range(r.randint(1, 3)))
    lines = []
    for _ in range(sentences):
        words = [word() for _ in range(r.randint(9, 14))]
        lines.append(" ".join(words).capitalize() + ".")
    return "\n".join(" ".join(lines[i: i + 3]) for i in range(0, len(lines), 3))


def changed(text, words, r):
    w = text.split(" ")
    for at in r.sample(range(len(w)), words):
        w[at] = f"zz{r.randrange(10 ** 6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    base = [prose(r) for _ in range(30)]
    texts = list(base)
    texts += [base[0], base[1].replace(" ", "  ") + "\n", base[1], base[2]]  # exact copies, but for white space
    texts += [changed(base[3], 1, r), changed(base[3], 2, r), changed(base[4], 1, r)]  # near copies
    texts += [changed(base[5], 12, r)]  # too far from its base
    texts += [prose(r) + f"\nWrite to ann{i}.lee@mail{i}.example.org for the whole list of them all today." for i in range(2)]
    texts += [None, "", " \n ", "Too short.", "home | about | login"]
    out = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return out + [out[7], (None, prose(r), None, None, None), (None, None, None, None, None)]


def one_of_each(rows):
    """Of texts alike but for white space, the longest and then smallest id."""
    groups = defaultdict(list)
    for row in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", row[1] or "")].append(row)
    return [min(g, key=lambda x: (-len(x[1] or ""), x[0] is None, x[0] or 0)) for g in groups.values()]


def one_of_near(rows):
    """Of rows linked at 0.8 the smallest id; rows without an id stay."""
    up = {row[0]: row[0] for row in rows if row[0] is not None}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    own = [row for row in rows if row[0] is not None]
    for i, a in enumerate(own):
        for b in own[i + 1:]:
            if jaccard(a[1], b[1]) >= 0.8:
                x, y = sorted((root(a[0]), root(b[0])))
                up[y] = x
    return [row for row in rows if row[0] is None or root(row[0]) == row[0]]


def key(row):
    return row[0] is None, row[0] or 0, row[1]


def test_stages_and_run(spark, rows, base):
    spark.createDataFrame(rows, DDL).repartition(3).write.parquet(f"{base}/documents.parquet")
    docs = spark.read.parquet(f"{base}/documents.parquet")
    names = [n for n, _ in c.STAGES]
    assert names == ["quality_rules", "exact_dedup", "ngram_join", "pii", "packing"]
    stage = dict(c.STAGES)

    def after(name, docs):
        path = f"{base}/{name}"
        stage[name](spark, docs, base).write.parquet(path)
        out = spark.read.parquet(path)
        assert out.columns == docs.columns
        return out, sorted((tuple(r) for r in out.collect()), key=key)

    clean, got = after("quality_rules", docs)
    prose_rows = [row for row in rows if row[1] and len(row[1].split()) >= 50]
    # clean texts stay; each line's outer white space may go
    assert sorted([key(r)[:2] for r in got]) == sorted(key(r)[:2] for r in prose_rows)
    assert {" ".join(r[1].split()) for r in got} == {" ".join(r[1].split()) for r in prose_rows}

    dedup, once = after("exact_dedup", clean)
    assert [r[:2] for r in once] == [r[:2] for r in sorted(one_of_each(got), key=key)]

    apart, few = after("ngram_join", dedup)
    want = sorted(one_of_near(once), key=key)
    assert few == want and len(want) < len(once) and any(jaccard(a[1], b[1]) > 0.2 for a in want for b in want if a is not b)

    hidden, safe = after("pii", apart)
    for before, row in zip(few, safe, strict=True):
        text = EMAIL.sub("[EMAIL]", before[1])
        assert row == (*before[:1], text, *before[2:4], len(text) if text != before[1] else before[4])
    assert any("[EMAIL]" in r[1] for r in safe)

    t = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    pieces = []
    for row in safe:
        ids = np.array(t.encode(row[1], add_special_tokens=False).ids + [1], "<u4")
        pieces += [(row[0], k // 4096, k, len(ids[k: k + 4096]), zlib.crc32(ids[k: k + 4096].tobytes()))
                   for k in range(0, len(ids), 4096)]
    for out in (stage["packing"](spark, hidden, base), c.run(spark, base)):
        packed = out.collect()
        found = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed]
        assert sorted(found, key=repr) == sorted(pieces, key=repr)
        places = defaultdict(list)
        for r in packed:
            places[r.sequence_id].append((r.offset, r.length))
        for own in places.values():
            assert [o for o, _ in sorted(own)] == [0, *np.cumsum([n for _, n in sorted(own)])[:-1].tolist()]
            assert sum(n for _, n in own) <= 4096
        assert len(places) == -(-sum(p[3] for p in pieces) // 4096) or len(places) <= len(pieces)


def test_empty_table(spark, base):
    spark.createDataFrame([], DDL).write.parquet(f"{base}/documents.parquet")
    assert c.run(spark, base).count() == 0


def test_near_dedup_links_five_word_shingles_at_80_percent(spark):
    words = [f"w{i}" for i in range(204)]
    near, far = list(words), list(words)
    near[100:118] = [f"n{i}" for i in range(18)]  # 22 of 200 shingles differ: 178 / 222 = 0.802
    far[100:119] = [f"f{i}" for i in range(19)]   # 23 of 200 differ: 177 / 223 = 0.794
    alone = " ".join(f"x{i}" for i in range(204))
    texts = [" ".join(w) for w in (words, near, far)]
    assert jaccard(texts[0], texts[1]) >= 0.8 > jaccard(texts[0], texts[2])
    df = spark.createDataFrame([(1, texts[0]), (2, texts[1]), (3, alone), (4, None)], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in c.near_dedup(spark, df, "").collect()) == [1, 3, 4]
    apart = spark.createDataFrame([(1, texts[0]), (2, texts[2])], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in c.near_dedup(spark, apart, "").collect()) == [1, 2]
