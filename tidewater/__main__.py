"""``spark-submit -m tidewater SPEC [--target ID ...]`` — run one spec file or every spec in
a directory (YAML first, then JSON, each sorted)."""
from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

from .plans import run_many
from .spec import load_spec, load_spec_dir


def main(argv: list[str] | None = None, stop_session: bool = True) -> int:
    parser = argparse.ArgumentParser(prog="tidewater", description=__doc__)
    parser.add_argument("spec", help="spec file (.yaml/.yml/.json) or a directory of specs")
    parser.add_argument("--target", action="append", default=None,
                        help="only this target id (or type); repeatable")
    parser.add_argument("--streaming", action="store_true", help="available-now streaming run")
    parser.add_argument("--parallel", type=int, default=1, help="datasets run at the same time")
    args = parser.parse_args(argv)
    specs = load_spec_dir(args.spec) if os.path.isdir(args.spec) else [load_spec(args.spec)]
    spark = SparkSession.builder.appName("tidewater").getOrCreate()
    failed = 0
    try:
        if args.streaming:
            from .streaming import run_available_now

            results = [r for spec in specs for r in run_available_now(spark, spec, targets=args.target)]
        else:
            results = run_many(spark, specs, parallelism=args.parallel, targets=args.target)
        for r in results:
            if isinstance(r, BaseException):
                failed += 1
                print(json.dumps({"error": f"{type(r).__name__}: {r}"}))
                continue
            print(json.dumps({"dataset": r.dataset_name, "rows": r.row_count, "targets": r.targets_written,
                              "watermark": r.watermark, "skipped": r.skipped,
                              "quality_passed": r.quality.passed if r.quality else None}))
    finally:
        if stop_session:
            spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
