"""A key or partition value holding a large share of the rows."""
from pyspark.sql import functions as F

from tidewater import fs
from tidewater.operators import dedup_latest
from tidewater.sinks import write_target
from tidewater.spec import TargetSpec

D = "/root/testdata/sf0.01"


def _hot(spark):
    """Orders where the urgent and high-priority ones (about 40 %) share customer 0."""
    o = spark.read.parquet(f"{D}/orders.parquet")
    return o.withColumn("o_custkey", F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit(0))
                        .otherwise(F.col("o_custkey")))


def test_dedup_on_hot_key_matches_brute_force(spark):
    df = _hot(spark)
    pdf = df.toPandas().sort_values(["o_orderdate", "o_orderkey"], ascending=False)
    expected = {r.o_custkey: r.o_orderkey for r in pdf.drop_duplicates("o_custkey").itertuples()}
    for method in ("agg", "window"):
        got = {r["o_custkey"]: r["o_orderkey"] for r in
               dedup_latest(df, ["o_custkey"], "o_orderdate", "o_orderkey", method=method).collect()}
        assert got == expected, method


def test_hot_partition_value_is_split_over_files(spark, base):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        # several input files, so several map tasks, as any large input has (AQE splits a
        # hot value along map outputs)
        (_hot(spark).withColumn("bucket", F.when(F.col("o_custkey") == 0, "hot").otherwise("rest"))
         .repartition(8).write.parquet(f"{base}/in"))
        df = spark.read.parquet(f"{base}/in")
        write_target(spark, df, TargetSpec("file", {"path": f"{base}/t"}, partition_columns=["bucket"]))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot_files = [f for f in spark.read.parquet(f"{base}/t/bucket=hot").inputFiles()]
    assert len(hot_files) > 1  # the hot value was written by several tasks
    assert spark.read.parquet(f"{base}/t").count() == df.count()
    assert fs.exists(spark, f"{base}/t/_SUCCESS")


def test_upsert_with_hot_null_keys_in_target(spark, base):
    df = _hot(spark).withColumn("o_custkey", F.when(F.col("o_custkey") != 0, F.col("o_custkey")))
    t = TargetSpec("file", {"path": f"{base}/u"}, write_mode="merge", merge_keys=["o_custkey"],
                   duplicate_keys="allow")
    write_target(spark, df, t)
    batch = df.filter(F.col("o_custkey").isNotNull()).limit(0).unionByName(
        df.filter("o_custkey IS NOT NULL AND o_orderdate >= '2001-01-01'"))
    write_target(spark, batch, t)
    out = spark.read.parquet(f"{base}/u")
    # NULL keys never match: all of them stay; matched keys are replaced by the batch rows
    nulls = df.filter("o_custkey IS NULL").count()
    assert out.filter("o_custkey IS NULL").count() == nulls
    kept = df.filter("o_custkey IS NOT NULL").join(batch.select("o_custkey").distinct(), "o_custkey", "left_anti")
    assert out.count() == nulls + kept.count() + batch.count()
