"""Spelling variants: counts, near words and chains against plain versions."""
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tidewater.llm import spelling_variants as v
from tidewater.llm.queries import ORACLE

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(n):
    by = {}
    for w in n:  # words one edit apart agree in a word or in a word without one character
        for key in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            by.setdefault(key, []).append(w)
    mates = {w: set() for w in n}
    for some in by.values():
        for w in some:
            mates[w] |= {x for x in some if near(w, x)}
    form = {}
    for w in n:
        best = min(mates[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {w: (form[w], root(w), n[w], len(mates[w]), n[form[w]] if form[w] else None) for w in n}


def rows_of(df):
    got = df.collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


def some_words(seed, k, alphabet, longest):
    r = random.Random(seed)
    words = {}
    while len(words) < k:
        w = "".join(r.choice(alphabet) for _ in range(r.randint(5, longest)))
        words[w] = r.choice([3, 4, 5, 7, 10, 20, 40, 90, 1000])
    return words


@pytest.mark.parametrize("alphabet,k,longest,limit", [
    ("ab", 300, 9, v.LIMIT), ("abé", 600, 8, v.LIMIT), ("abé", 600, 8, 4), ("abcÿ", 900, 7, 20), ("ab", 250, 40, 1),
    ("aàz", 120, 300, 10)])
def test_random_words(spark, alphabet, k, longest, limit):
    words = some_words(k, k, alphabet, longest)
    df = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(3)
    assert rows_of(v.group_variants(df, limit)) == plain_groups(words)


def test_chains_and_ties(spark):
    words = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "ccccc": 5, "ccccd": 10, "cccca": 10,
             "x" * 3000: 3, "x" * 2999: 9, "solitary": 7}
    got = rows_of(v.group_variants(spark.createDataFrame(list(words.items()), "word string, n bigint")))
    assert got == plain_groups(words)
    assert got["aaaaa"][:2] == ("aaaab", "bbbbb") and got["ccccc"][0] == "cccca"
    assert got["solitary"] == (None, "solitary", 7, 0, None)


def test_rows_are_used_again_and_ranges_skipped():
    """The words after a shared prefix that is over one edit away cost no step each."""
    words = sorted({"aa" + x for x in some_words(1, 4000, "abcde", 8) if len(x) > 6})
    m, length = v._matrix(pa.array(words))
    n = len(words)
    steps = 0

    class Counted(np.ndarray):
        def __getitem__(self, at):
            nonlocal steps
            if isinstance(at, tuple) and isinstance(at[0], np.ndarray):
                steps += len(at[0])
            return super().__getitem__(at)

    shared = np.full(n, 2)
    a, b = v.near_pairs(m.view(Counted), length, np.zeros(n, int), np.full(n, n), np.full(n, 9), shared)
    queries = int((length == 9).sum())
    assert steps / 4 < 0.2 * queries * int(length.sum())
    want = {(x, y) for i, x in enumerate(words) if len(x) == 9 for y in words
            if near(x, y) and (len(y) == 10 or len(y) == 9 and x < y)}
    assert {(words[i], words[j]) for i, j in zip(a.tolist(), b.tolist())} == want


ODD = [None, "", "Über-Größe ×÷ naïve naïve NAÏVE ÀÉ ÿÿÿÿÿ œuvre", "a1b2 don't word", "É" * 400 + " " + "Z" * 100_000, "日本 abcdefg"]


def test_counts(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(9000 + i, t) for i, t in enumerate(ODD)] * 3 + [(None, "nullid nullid nullid nullid")]
    df = spark.createDataFrame([(1, i, t, "x") for i, t in rows], "n int, doc_id bigint, text string, word string")
    got = {r.word: r.n for r in v.count_words(df.repartition(3)).collect()}
    assert got == plain_counts(rows)
    assert rows_of(v.spelling_variants(df)) == plain_groups(got)


def test_checksums_of_every_length():
    r = random.Random(0)
    parts = [bytes(r.randrange(256) for _ in range(k)) for k in [*range(0, 60), 300, 48, 49]]
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    begun = np.array([zlib.crc32(b"%d:" % i) for i in range(len(parts))], np.uint32)
    assert v.checksums(data, starts, ends, begun).tolist() == [zlib.crc32(b"%d:" % i + p) for i, p in enumerate(parts)]


def test_empty_table(spark):
    assert v.spelling_variants(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_given_table_and_sql(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    docs = spark.read.parquet(path)
    got = rows_of(v.spelling_variants(docs))
    assert got == plain_groups(plain_counts([(r.doc_id, r.text) for r in docs.collect()]))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}')")
    assert {r[0]: r[1:] for r in con.execute(ORACLE["op13_spelling_variants"]).fetchall()} == got
