"""Write PLANS.md: the formatted physical plans of the headline operators at a given scale.

    python tools/dump_plans.py [/root/testdata/sf0.1]
"""
from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater import local_session  # noqa: E402
from tidewater.operators import dedup_latest, merge_plan  # noqa: E402
from tidewater.operators.upsert import matched_partitions  # noqa: E402
from tidewater.operators.quality import profile_columns  # noqa: E402
from tidewater.plans import prepare_batch  # noqa: E402
from tidewater.plans import state as st  # noqa: E402
from tidewater.queries import CUT, _full_spec, incremental_scan  # noqa: E402
from tidewater.spec import spec_from_dict  # noqa: E402
from tidewater.session import scratch_path, unique_name  # noqa: E402
from tidewater.sinks.common import rebalance  # noqa: E402
from tidewater.spec import QualitySpec  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main(sf_dir: str) -> None:
    spark = local_session(8)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    later = orders.filter(f"o_orderdate > timestamp_ntz'{CUT}'")
    by_priority = scratch_path(spark, "plans_by_priority")
    orders.write.partitionBy("o_orderpriority").parquet(by_priority)
    partitioned = spark.read.parquet(by_priority)
    bucketed = unique_name("plans_bucketed")
    orders.write.option("path", scratch_path(spark, "plans")).bucketBy(16, "o_orderkey").saveAsTable(bucketed)
    run_base = scratch_path(spark, "plans_run")
    st.commit_state(spark, f"{run_base}/state", "orders",
                    [st.StateEntry("file", "o_orderdate", "timestamp_ntz", CUT, 1)])
    run_batch = prepare_batch(spark, spec_from_dict(_full_spec(run_base, sf_dir)), recover=False).df
    cases = [
        ("Flagship run (`ingest_full`), batch as the run executes it: pushed watermark, partial "
         "max_by dedup, metadata literals", run_batch),
        ("Incremental scan: watermark pushed to Parquet", incremental_scan(spark, sf_dir)),
        ("Latest row per key (window): partial WindowGroupLimit before the exchange",
         dedup_latest(orders, ["o_custkey"], "o_orderdate", "o_orderkey")),
        ("Latest row per key (max_by): partial aggregate before the exchange",
         dedup_latest(orders, ["o_custkey"], "o_orderdate", "o_orderkey", method="agg")),
        ("Quality profile: one aggregate, pruned columns",
         orders.agg(*profile_columns(orders, QualitySpec(max_null_fraction={"o_custkey": 0.1}), "o_orderdate"))),
        ("Upsert, small batch: key-only broadcast anti join", merge_plan(orders, later, ["o_orderkey"],
                                                                        broadcast_keys=True)),
        ("Upsert into a bucketed table: target read without a shuffle",
         merge_plan(spark.table(bucketed), later, ["o_orderkey"])),
        ("Partitioned write: rebalanced by partition value", rebalance(events, ["event_type"])),
        ("Upsert into a target partitioned outside the key: partitions holding a matched key "
         "(semi join reading only the key column)",
         matched_partitions(partitioned, later, ["o_orderkey"], ["o_orderpriority"]).distinct()),
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # show the non-broadcast shapes
    out = [f"# Physical plans ({os.path.basename(sf_dir)}, local[8], AQE on)\n",
           "Generated by `tools/dump_plans.py`; initial plans (AQE re-plans at runtime).\n"]
    for title, df in cases:
        out.append(f"\n## {title}\n\n```\n{formatted(df).strip()}\n```\n")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
