"""Quality rules against a plain per-text implementation."""
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewater.llm import quality_rules as q

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i:i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), failed)


ODD = [None, "", " \t\n\r\x0b\x0c ", "one", "a b c a b c", "é\u00a0ü x\u2003y", "l\nl\n\nl\r\n l", "#*$%&|<> & x",
       "x " * 3000, "word " * 40 + "\n" + "tail\n" * 5, "ab\n", "\nab\n\nab", "😀 a😀 b " * 60]


@pytest.fixture(scope="module")
def frame(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = docs + [(10_000 + i, t) for i, t in enumerate(ODD)] + [(None, "x y"), (10_000, None)]
    return rows, spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, n_words int, kept int")


def test_base_counts(frame):
    rows, df = frame
    got = sorted(((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in q.judge_documents(df).collect()))
    assert got == sorted((i or -1, *plain(t)) for i, t in rows)


def test_rejects_what_the_base_rules_reject(frame):
    rows = q.judge_documents(frame[1]).collect()
    assert not [r for r in rows if r.kept and r.base_failed]


def test_line_rules(spark):
    good = "The quick brown fox walked over to another hill and sat down there. " * 1
    body = " ".join(f"word{i} other{i * 7}." for i in range(60))
    rows = [(1, body + "\n" + good), (2, body + "\nhome | news | about | contact | login | help |"),
            (3, "\n".join(f"a{i}### b{i}### c{i}$$$ d{i}%%%" for i in range(30))),
            (4, body + "\nWe use cookies: see our Cookie Policy here."), (5, body.upper()),
            (6, body + "\n" + "repeated line here.\nrepeated line here.")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_failed_lines, r.kept) for r in q.judge_documents(df).collect()}
    assert got == {1: (0, True), 2: (1, True), 3: (30, False), 4: (1, True), 5: (1, False), 6: (1, True)}


def test_clean_documents_keeps_columns_and_takes_lines_out(spark):
    body = " ".join(f"word{i} other{i * 7}." for i in range(60))
    df = spark.createDataFrame([(1, body + "\nsee our cookie policy", "en", None, 5.0), (2, "short", "en", 3, None),
                                (3, body, None, 4, 1.0)], "doc_id bigint, text string, lang string, n_chars bigint, kept double")
    out = q.clean_documents(df)
    assert out.schema == df.schema
    assert sorted(map(tuple, out.collect())) == [(1, body, "en", len(body), 5.0), (3, body, None, 4, 1.0)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert q.judge_documents(df).count() == 0 and q.clean_documents(df).count() == 0


def test_clean_share_of_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = q.judge_documents(docs).agg(F.avg(F.col("kept").cast("int")).alias("kept"),
                                       F.avg(F.col("base_failed").cast("int")).alias("base")).first()
    assert rows.kept > 0.75 * (1 - rows.base)


def test_a_phrase_fails_short_lines_and_lines_full_of_phrases_only(spark):
    body = " ".join(f"word{i} other{i * 7}." for i in range(1500))
    short = body[:2000]
    footer = " ".join(["Privacy Policy", "Terms of Use", "All rights reserved.", "one two three four"] * 3)
    rows = [(1, f"{body} You can read more in chapter two, or log in."),  # one long line that mentions some
            (2, f"{short}\nthe blog in question"), (3, f"{short}\na catalog indeed"), (4, f"{short}\nto spread moreover"),
            (5, f"{short}\nplease (Log in)!"), (6, f"{short}\n{footer}")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_failed_lines, r.kept) for r in q.judge_documents(df).collect()}
    assert got == {1: (0, True), 2: (0, True), 3: (0, True), 4: (0, True), 5: (1, True), 6: (1, True)}
    assert {r.doc_id: r.text for r in q.clean_documents(df).collect()}[1] == rows[0][1]


def test_memory_is_that_of_a_small_batch(spark, monkeypatch):
    """A worker takes little text at a time, whatever the size of Spark's batch."""
    import tracemalloc

    import pyarrow as pa

    from tidewater.llm import quality_rules
    from tidewater.llm._spark import cut

    monkeypatch.setattr(quality_rules, "map_batches", lambda df, fn, schema, limit=2_000_000: (fn, limit))
    text = "\n".join(" ".join(f"w{i}x{j}" for j in range(12)) + "." for i in range(60))
    batch = pa.RecordBatch.from_arrays([pa.array(range(2000)), pa.array([text] * 2000)], names=["doc_id", "text"])
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    for fn, limit in (quality_rules.clean_documents(docs), quality_rules.judge_documents(docs)):
        kept = 0
        tracemalloc.start()
        for part in cut(batch, limit):
            kept += sum(out.num_rows for out in fn(part))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert kept == 2000 and peak < 80e6, peak
