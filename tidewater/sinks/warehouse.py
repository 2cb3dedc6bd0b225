"""Warehouse / JDBC targets.

Append and overwrite are Spark's parallel JDBC (or warehouse connector) writes. An
upsert writes the batch in parallel to a staging table whose name carries the batch id
(runs never share one), then issues a single ``MERGE`` in the warehouse, so the merge
itself runs where the data lives. Statements run through the format's own runner: one JDBC
connection opened by the driver, or the connector's statement utility. Column names are
quoted, with the format's quote sign, as Spark's writer quotes them when it creates a table.
"""
from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession

from ..errors import MissingOptionError
from ..secrets import resolve_options
from ..spec import SNOWFLAKE_FORMAT, TargetSpec
from .common import WriteContext, WriteReport, observed, observed_metrics

# Spec options that are ours, not connector options.
OWN_OPTIONS = ("table", "staging_table", "format", "schema_evolution", "write_options")

StatementRunner = Callable[[SparkSession, dict, str], None]


def _table(target: TargetSpec) -> str:
    table = target.options.get("table")
    if not table:
        raise MissingOptionError("Warehouse target requires 'table' option")
    return str(table)


def connection_options(target: TargetSpec) -> dict[str, str]:
    opts = resolve_options(target.options)
    return {k: str(v) for k, v in opts.items() if k not in OWN_OPTIONS and v is not None}


def _format(target: TargetSpec) -> str:
    return str(target.options.get("format", "jdbc"))


def merge_statement(table: str, staging: str, columns: list[str], keys: list[str],
                    quote: Callable[[str], str] = str) -> str:
    """``MERGE`` of a staging table into ``table``: matched rows update their non-key
    columns, the others are inserted. With only key columns there is nothing to update,
    so the ``WHEN MATCHED`` clause is left out instead of emitting an empty ``SET``."""
    q = {c: quote(c) for c in (*columns, *keys)}
    on = " AND ".join(f"t.{q[k]} = s.{q[k]}" for k in keys)
    updates = ", ".join(f"{q[c]} = s.{q[c]}" for c in columns if c not in keys)
    cols = ", ".join(q[c] for c in columns)
    vals = ", ".join(f"s.{q[c]}" for c in columns)
    parts = [f"MERGE INTO {table} t USING {staging} s ON {on}"]
    if updates:
        parts.append(f"WHEN MATCHED THEN UPDATE SET {updates}")
    parts.append(f"WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({vals})")
    return " ".join(parts)


def jdbc_statement_runner(spark: SparkSession, options: dict, sql: str) -> None:
    """Run one statement over a JDBC connection opened by the driver JVM."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for key in ("user", "password"):
        if key in options:
            props.setProperty(key, options[key])
    if "driver" in options:
        jvm.java.lang.Class.forName(options["driver"])
    conn = jvm.java.sql.DriverManager.getConnection(options["url"], props)
    try:
        stmt = conn.createStatement()
        try:
            stmt.execute(sql)
        finally:
            stmt.close()
    finally:
        conn.close()


def connector_statement_runner(spark: SparkSession, options: dict, sql: str) -> None:
    """Run one statement through the warehouse connector's utility class in the driver JVM."""
    utility = spark.sparkContext._jvm
    for name in CONNECTOR_UTILITY.split("."):
        utility = getattr(utility, name)
    utility.runQuery(options, sql)  # takes a java.util.Map


# The connector format, its statement utility, and what runs statements.
CONNECTOR_UTILITY = f"{SNOWFLAKE_FORMAT}.Utils"
RUNNERS: dict[str, StatementRunner] = {SNOWFLAKE_FORMAT: connector_statement_runner}


def statement_runner(target: TargetSpec) -> StatementRunner:
    """The runner of the target's format; plain JDBC unless the format has its own."""
    return RUNNERS.get(_format(target), jdbc_statement_runner)


def identifier_quote(target: TargetSpec) -> Callable[[str], str]:
    """Quotes as the format's writer does: backticks for MySQL-like urls, brackets for SQL
    Server, double quotes otherwise. The connector folds names to upper case unquoted and
    takes them as they are when it creates a table, so nothing is quoted for it."""
    if _format(target) == SNOWFLAKE_FORMAT:
        return str
    url = str(target.options.get("url", "")).lower()
    if url.startswith(("jdbc:mysql", "jdbc:mariadb", "jdbc:databricks")):
        return lambda c: "`" + c.replace("`", "``") + "`"
    if url.startswith("jdbc:sqlserver"):
        return lambda c: "[" + c.replace("]", "]]") + "]"
    return lambda c: '"' + c.replace('"', '""') + '"'


def _save(df: DataFrame, target: TargetSpec, table: str, mode: str, extra: dict | None = None) -> dict:
    df, obs = observed(df, False)
    writer = df.write.format(_format(target)).options(**connection_options(target)).option("dbtable", table)
    for k, v in (extra or {}).items():
        writer = writer.option(k, v)
    writer.mode(mode).save()
    return observed_metrics(obs)


def warehouse_append(spark: SparkSession, df: DataFrame, target: TargetSpec, ctx: WriteContext) -> WriteReport:
    table = _table(target)
    metrics = _save(df, target, table, "append")
    return WriteReport(target.id, target.type, "append", metrics["rows"], table)


def warehouse_overwrite(spark: SparkSession, df: DataFrame, target: TargetSpec, ctx: WriteContext) -> WriteReport:
    table = _table(target)
    # Keep the table definition (grants, types) and only empty it.
    extra = {"truncate": "true"} if _format(target) == "jdbc" else None
    metrics = _save(df, target, table, "overwrite", extra)
    return WriteReport(target.id, target.type, "overwrite", metrics["rows"], table)


def warehouse_upsert(spark: SparkSession, df: DataFrame, target: TargetSpec, ctx: WriteContext,
                     runner: StatementRunner | None = None) -> WriteReport:
    """Stage, ``MERGE``, and drop the stage if its name is ours, also after a merge that failed (a retry
    stages anew); a stage the user named stays."""
    table, named = _table(target), target.options.get("staging_table")
    run = runner or statement_runner(target)
    staging = str(named or f"{table}_stage_{int(ctx.batch_id)}")
    metrics = _save(df, target, staging, "overwrite")
    opts = connection_options(target)
    merge = merge_statement(table, staging, df.columns, list(target.merge_keys), identifier_quote(target))
    with ExitStack() as after:
        if not named:
            after.callback(run, spark, opts, f"DROP TABLE {staging}")
        run(spark, opts, merge)
    return WriteReport(target.id, target.type, "merge", metrics["rows"], table, extra={"staging": staging})
