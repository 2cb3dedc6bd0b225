"""Quarantine (dead-letter) output: the whole violating batch, only the bad rows, or the
records that did not parse."""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import reason_column

DLQ_REASON = "_dlq_reason"
DLQ_RAW = "_dlq_raw"
DLQ_FIELDS = "_dlq_fields"
REASON = "__reason"


def quarantine_path(base_path: str, dataset: str) -> str:
    return f"{base_path.rstrip('/')}/{dataset}"


def quarantine_batch(df: DataFrame, base_path: str, dataset: str, reason: str) -> str:
    """Append the whole batch with a ``_dlq_reason`` column as Parquet under ``<base>/<dataset>``."""
    path = quarantine_path(base_path, dataset)
    df.withColumn(DLQ_REASON, F.lit(reason)).write.mode("append").parquet(path)
    return path


def annotate_rows(df: DataFrame, not_null: list[str] | None = None,
                  rules: dict[str, str] | None = None) -> DataFrame:
    """Add ``__reason``: the broken row rules of each row, ``""`` when it has none."""
    return df.withColumn(REASON, reason_column(not_null, rules))


def bad_rows(annotated: DataFrame) -> DataFrame:
    return (annotated.filter(F.col(REASON) != "")
            .withColumn(DLQ_REASON, F.col(REASON)).drop(REASON))


def good_rows(annotated: DataFrame) -> DataFrame:
    return annotated.filter(F.col(REASON) == "").drop(REASON)


def quarantine_rows(annotated: DataFrame, base_path: str, dataset: str) -> str:
    """Append only the rows that break a rule, each with its own ``_dlq_reason``."""
    path = quarantine_path(base_path, dataset)
    bad_rows(annotated).write.mode("append").parquet(path)
    return path


def quarantine_unparsed(failed: DataFrame, base_path: str, dataset: str, raw: str,
                        fields: str) -> tuple[str, int]:
    """Append records that did not parse under ``<base>/<dataset>_unparsed``: their parsed fields,
    ``_dlq_raw``, the failed ``_dlq_fields`` and a reason. Returns the path and the observed count."""
    path = f"{quarantine_path(base_path, dataset)}_unparsed"
    obs = Observation()
    out = failed.withColumns({DLQ_REASON: F.concat(F.lit("unparsed: "), F.array_join(fields, ", ")),
                              DLQ_RAW: F.col(raw), DLQ_FIELDS: F.col(fields)}).drop(raw, fields)
    out.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return path, int((obs.get or {}).get("rows") or 0)
