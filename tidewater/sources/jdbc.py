"""JDBC source: a table or a query, optionally read in parallel ranges of one column.

``query`` is passed as Spark's real ``query`` option unless a partitioned read is asked
for; then it is wrapped as ``(query) src`` in ``dbtable``, which Spark requires for
``partitionColumn``. Missing bounds come from one ``min``/``max`` query in the database.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..errors import MissingOptionError
from ..secrets import resolve_options
from ..spec import SourceSpec

# Spec option names that map onto Spark's partitioned-read options.
PARTITION_OPTIONS = {
    "partition_column": "partitionColumn",
    "lower_bound": "lowerBound",
    "upper_bound": "upperBound",
    "num_partitions": "numPartitions",
}


def jdbc_options(options: dict) -> dict[str, str]:
    """Spark JDBC reader options for a spec's source options (no I/O)."""
    opts = {k: str(v) for k, v in resolve_options(options).items() if v is not None}
    for ours, spark_name in PARTITION_OPTIONS.items():
        if ours in opts:
            opts[spark_name] = opts.pop(ours)
    query = opts.pop("query", None)
    table = opts.pop("dbtable", None)
    if not query and not table:
        raise MissingOptionError("JDBC source requires 'query' or 'dbtable' option")
    partitioned = "partitionColumn" in opts
    if query and partitioned:
        opts["dbtable"] = f"({query}) src"
    elif query:
        opts["query"] = query
    else:
        opts["dbtable"] = table
    return opts


def _bounds(spark: SparkSession, opts: dict[str, str]) -> tuple[str, str]:
    column = opts["partitionColumn"]
    relation = opts["dbtable"]
    if not relation.lstrip().startswith("("):
        relation = f"(SELECT * FROM {relation}) src"
    probe = {k: v for k, v in opts.items()
             if k not in ("partitionColumn", "lowerBound", "upperBound", "numPartitions", "dbtable")}
    probe["query"] = f"SELECT min({column}) AS lo, max({column}) AS hi FROM {relation} b"
    row = spark.read.format("jdbc").options(**probe).load().first()
    return str(row[0]), str(row[1])


def read_jdbc(spark: SparkSession, source: SourceSpec) -> DataFrame:
    opts = jdbc_options(source.options)
    if "partitionColumn" in opts and ("lowerBound" not in opts or "upperBound" not in opts):
        lo, hi = _bounds(spark, opts)
        opts.setdefault("lowerBound", lo)
        opts.setdefault("upperBound", hi)
        opts.setdefault("numPartitions", str(spark.sparkContext.defaultParallelism))
    return spark.read.format("jdbc").options(**opts).load()
