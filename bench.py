"""Benchmark: headline operators at $BENCH_SF_DIR on local[$BENCH_CPUS].

Warm session, median of 3 timed runs per query (one untimed warm-up). Pure plans are
forced with the ``noop`` sink so the whole plan runs without collecting to the driver.
Upserts time only the upsert write (the target is prepared outside the timed region).
Prints ONE JSON line.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidewater import local_session, run, spec_from_dict  # noqa: E402
from tidewater.operators import check_quality, dedup_latest  # noqa: E402
from tidewater.plans import state as st  # noqa: E402
from tidewater.queries import (CUT, REVISED_FROM, _full_spec, incremental_scan,  # noqa: E402
                               ingest_lineitem_latest)
from tidewater.session import scratch_path  # noqa: E402
from tidewater.sinks import WriteContext, write_target  # noqa: E402
from tidewater.spec import QualitySpec, TargetSpec  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(fn, setup=None) -> float:
    times = []
    for i in range(REPEAT + 1):
        arg = setup() if setup else None
        t = time.perf_counter()
        fn(arg)
        if i:  # first run warms caches and code paths
            times.append(time.perf_counter() - t)
    return statistics.median(times)


def main() -> None:
    cpus = int(CPUS)
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="tidewater-bench",
                          extra={"spark.driver.memory": "16g"})
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    lineitem = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    n_orders = orders.count()
    n_lineitem = lineitem.count()
    nulled = orders.withColumn("o_custkey", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")))
    dq = QualitySpec(min_row_count=1, max_null_fraction={"o_custkey": 0.1, "o_orderstatus": 0.0})
    secs: dict[str, float] = {}
    rows: dict[str, int] = {}

    secs["incremental_scan"] = _timed(lambda _: _noop(incremental_scan(spark, SF_DIR)))
    rows["incremental_scan"] = n_orders

    secs["dedup_latest_window"] = _timed(lambda _: _noop(
        dedup_latest(lineitem, ["l_orderkey"], "l_shipdate", ["l_linenumber", "l_partkey"], method="window")))
    secs["dedup_latest_max_by"] = _timed(lambda _: _noop(
        dedup_latest(lineitem, ["l_orderkey"], "l_shipdate", ["l_linenumber", "l_partkey"], method="agg")))
    rows["dedup_latest_window"] = rows["dedup_latest_max_by"] = n_lineitem

    secs["dq_suite_one_pass"] = _timed(lambda _: check_quality(nulled, dq))

    def per_check(_):  # one job per check, as a naive implementation would run them
        n = nulled.count()
        for c in dq.max_null_fraction:
            nulled.filter(F.col(c).isNull()).count()
        return n
    secs["dq_suite_per_check"] = _timed(per_check)
    rows["dq_suite_one_pass"] = rows["dq_suite_per_check"] = n_orders

    revised = (orders.filter(F.col("o_orderdate") >= F.lit(REVISED_FROM).cast("timestamp_ntz"))
               .withColumn("o_totalprice", F.col("o_totalprice") * 2))
    n_revised = revised.count()

    def fresh_target(partitioned: bool):
        def _setup():
            path = scratch_path(spark, "bench_upsert")
            keys = ["o_orderkey", "o_orderstatus"] if partitioned else ["o_orderkey"]
            t = TargetSpec("file", {"path": path}, write_mode="merge", merge_keys=keys,
                           partition_columns=["o_orderstatus"] if partitioned else [])
            write_target(spark, orders, t, WriteContext(batch_rows=n_orders))
            return t
        return _setup

    secs["upsert_file_full"] = _timed(
        lambda t: write_target(spark, revised, t, WriteContext(batch_rows=n_revised)), fresh_target(False))
    secs["upsert_file_touched_partitions"] = _timed(
        lambda t: write_target(spark, revised.filter("o_orderstatus = 'O'"), t, WriteContext(batch_rows=n_revised)),
        fresh_target(True))
    rows["upsert_file_full"] = rows["upsert_file_touched_partitions"] = n_orders

    # files of consecutive dates, as incremental loads leave them: the batch's orders lie in few
    def dated_target(scope: str):
        def _setup():
            t = TargetSpec("file", {"path": scratch_path(spark, "bench_files"), "rewrite": scope}, write_mode="merge",
                           merge_keys=["o_orderkey"])
            orders.repartitionByRange(32, "o_orderdate").write.parquet(t.options["path"])
            return t
        return _setup

    last = orders.filter(F.col("o_orderdate") >= F.lit(CUT).cast("timestamp_ntz")).withColumn("o_totalprice", F.lit(0.0))
    n_last = last.count()
    for scope in ("partitions", "files", "marks"):
        name = f"upsert_dated_{'all' if scope == 'partitions' else scope}"
        secs[name] = _timed(lambda t: write_target(spark, last, t, WriteContext(batch_rows=n_last)), dated_target(scope))
        rows[name] = n_orders

    jobs = {}

    def full_run(base):
        group = f"bench-{time.time_ns()}"
        spark.sparkContext.setJobGroup(group, "ingest_full")
        run(spark, spec_from_dict(_full_spec(base, SF_DIR)))
        jobs["ingest_full"] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        spark.sparkContext.setJobGroup("", "")

    def full_setup():
        base = scratch_path(spark, "bench_full")
        st.commit_state(spark, f"{base}/state", "orders",
                        [st.StateEntry("file", "o_orderdate", "timestamp_ntz", CUT, 1)])
        return base

    secs["ingest_full"] = _timed(full_run, full_setup)
    rows["ingest_full"] = n_orders

    # two incremental runs over lineitem: dedup of repeated line keys, merge into a target
    # partitioned outside the key (partition-scoped rewrite with keys moving partitions)
    secs["ingest_lineitem_two_runs"] = _timed(lambda _: ingest_lineitem_latest(spark, SF_DIR))
    rows["ingest_lineitem_two_runs"] = n_lineitem

    headline = ["incremental_scan", "dedup_latest_max_by", "dq_suite_one_pass", "upsert_file_full", "ingest_full",
                "ingest_lineitem_two_runs"]
    out = {
        "metric": "headline_total_sec",
        "value": round(sum(secs[q] for q in headline), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in secs.items()},
        "rows_per_sec": {k: round(rows[k] / secs[k]) for k in secs if secs[k] > 0},
        "spark_jobs": jobs,
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
