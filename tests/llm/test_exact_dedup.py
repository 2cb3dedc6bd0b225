"""Exact deduplication against a dictionary of complete contents."""
import hashlib
import random
import re
from collections import defaultdict

from tidewater.llm import exact_dedup as x

SCHEMA = "doc_id bigint, text string, kept string"


def plain(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
    out = []
    for content, members in groups.items():
        best = min(members)
        out += [(i, best[1], len(members), i == best[1], hashlib.sha256(content.encode()).hexdigest()) for _, i in members]
    return sorted(out)


def rows_of(spark):
    r = random.Random(3)
    base = ["", " ", None, "a b", "ab", "a\tb\x0b", "é x", "éx", "x" * 50_000, "x" * 50_000 + " "]
    texts = [r.choice(base) if r.random() < .3 else " ".join(r.choice("abcd") for _ in range(r.randint(0, 6))) for _ in range(900)]
    return list(enumerate(texts)) + [(5000 + i, "hot  copy") for i in range(300)]


def test_groups(spark):
    rows = rows_of(spark)
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], SCHEMA).repartition(7)
    assert sorted(map(tuple, x.exact_groups(df).collect())) == plain(rows)


def test_groups_when_buckets_are_split_again(spark):
    rows = rows_of(spark)
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], SCHEMA)
    assert sorted(map(tuple, x.exact_groups(df, table_bytes=300).collect())) == plain(rows)


def test_drop_copies(spark):
    rows = rows_of(spark)
    df = spark.createDataFrame([(i, t, "z") for i, t in rows] * 2, SCHEMA)
    out = x.drop_copies(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted({r[1] for r in plain(rows)})


def test_rows_are_dealt_out_once(spark):
    """Besides the contents, each row goes through one shuffle, on its way to the winners."""
    from pyspark.sql import functions as F
    df = spark.range(50).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 40).alias("text"))
    plan = x.drop_copies(df)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 3
    assert sorted(r.doc_id for r in x.drop_copies(df).collect()) == list(range(40))


def test_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a", ""), (1, "a", ""), (1, "b", ""), (None, "c", ""), (None, "a", "")], SCHEMA)
    got = x.exact_groups(df).collect()
    assert len(got) == 5 and sum(r.kept for r in got) == 3
    assert {(r.keep_id, r.group_size) for r in got} == {(1, 3), (1, 1), (None, 1)}
    assert x.drop_copies(df).count() == 3


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert x.exact_groups(df).count() == 0 and x.drop_copies(df).count() == 0


def test_table_compares_content():
    import pytest
    t = x.ContentTable(4)
    for i in range(100):
        t.entry(hashlib.sha256(b"%d" % i).digest(), b"%d" % i).append(i)
    assert [t.entry(hashlib.sha256(b"%d" % i).digest(), b"%d" % i) for i in range(100)] == [[i] for i in range(100)]
    with pytest.raises(ValueError):
        t.entry(hashlib.sha256(b"1").digest(), b"other")


def test_rows_of_one_id_that_differ_in_white_space(spark):
    df = spark.createDataFrame([(1, "a b", ""), (1, "a  b", ""), (1, "a\t b", "")], SCHEMA).coalesce(1)
    got = x.exact_groups(df).collect()
    assert len(got) == 3 and sum(r.kept for r in got) == 1 and {r.keep_id for r in got} == {1}
    assert [len(r.text) for r in x.drop_copies(df).collect()] == [4]


def test_rows_that_come_from_a_shuffle_lose_no_group(spark):
    from pyspark.sql import functions as F
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    try:
        df = (spark.range(2000).repartition(3).groupBy(F.col("id").alias("doc_id"))
              .agg(F.concat(F.lit("t "), F.first(F.col("id") % 1500).cast("string")).alias("text"),
                   F.first(F.expr("array_join(transform(sequence(1, 60), i -> md5(cast(id * i as string))), '')")).alias("kept")))
        assert sorted(r.doc_id for r in x.drop_copies(df).collect()) == list(range(1500))
        assert sorted(r.doc_id for r in x.exact_groups(df).collect() if r.kept) == list(range(1500))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")


def test_ids_of_all_sizes(spark):
    """No id stands for a missing one."""
    top = 1 << 62
    rows = [(None, "a"), (top + 5, "a"), (top + 9, "a "), (top, "alone"), (None, "b"), (-7, "b"), ((1 << 63) - 1, "c"),
            (-(1 << 63), "c"), (None, "d"), (None, "d")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {(r.text_sha256, r.doc_id): (r.keep_id, r.group_size, r.kept) for r in x.exact_groups(df).collect()}

    def of(content, doc_id):
        return got[hashlib.sha256(content.encode()).hexdigest(), doc_id]
    assert of("a", top + 9) == (top + 9, 3, True) and of("a", None) == (top + 9, 3, False)
    assert of("alone", top) == (top, 1, True)
    assert of("b", -7) == (-7, 2, True) and of("b", None) == (-7, 2, False)
    assert of("c", -(1 << 63)) == (-(1 << 63), 2, True)
    kept = sorted(((r.doc_id is None, r.doc_id or 0), r.text) for r in x.drop_copies(df).collect())
    assert kept == [((False, -(1 << 63)), "c"), ((False, -7), "b"), ((False, top), "alone"), ((False, top + 9), "a "),
                    ((True, 0), "d")]
