"""Catalog and relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from visitlens.schemas import RATIO_TABLE

TASK_COLUMN = "taskid"


def replace_table(df: DataFrame, table: str, partition_by: str | None = None) -> None:
    """Replace a managed table, created if it does not exist.

    With ``partition_by`` the rows are rebalanced on that column first: small values
    share files and a crowded one is split over tasks. Actions saved by ``date`` let
    the date range of a task skip whole partitions.
    """
    if partition_by is None:
        df.write.mode("overwrite").saveAsTable(table)
    else:
        rebalanced = df.hint("rebalance", partition_by)
        rebalanced.write.mode("overwrite").partitionBy(partition_by).saveAsTable(table)


def replace_task(df: DataFrame, table: str) -> None:
    """Put a task's result into a table partitioned by ``taskid``, in place of what an earlier
    try of the same task left there. Other tasks' rows stay."""
    spark = df.sparkSession
    ordered = df.select(*[name for name in df.columns if name != TASK_COLUMN], TASK_COLUMN)
    if not spark.catalog.tableExists(table):
        ordered.write.partitionBy(TASK_COLUMN).saveAsTable(table)
        return
    parts = [column.name for column in spark.catalog.listColumns(table) if column.isPartition]
    if parts != [TASK_COLUMN]:
        raise ValueError(f"{table} must be partitioned by {TASK_COLUMN}, not by {parts}")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        ordered.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def append_jdbc(
    df: DataFrame,
    url: str,
    user: str,
    password: str,
    table: str = RATIO_TABLE,
    driver: str | None = None,
    connections: int = 1,
) -> None:
    """Append a result to a relational table over a number of connections.

    Each is one partition and one transaction. With one, as fits the single row of ratios, a
    retried task leaves no half-written result; a larger result needs more.
    """
    options = {"url": url, "user": user, "password": password, "dbtable": table}
    if driver:
        options["driver"] = driver
    df.coalesce(connections).write.format("jdbc").options(**options).mode("append").save()
