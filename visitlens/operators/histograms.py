"""How sessions spread over duration and length."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.functions.values import ratio
from visitlens.schemas import RATIOS, STEP_BUCKETS, VISIT_BUCKETS


def _in_bucket(column: str, low: int, high: int | None) -> str:
    return f"{column} >= {low}" if high is None else f"{column} between {low} and {high}"


def _histogram(sessions: DataFrame, column: str, buckets) -> DataFrame:
    cases = " ".join(
        f"when {_in_bucket(column, low, high)} then '{name}'" for name, low, high in buckets
    )
    return (
        sessions.selectExpr(f"case {cases} end as bucket")
        .where("bucket is not null")
        .groupBy("bucket")
        .agg(F.expr("count(*) as sessions"))
    )


def visit_length_histogram(sessions: DataFrame) -> DataFrame:
    """Sessions per duration bucket; an empty bucket has no row."""
    return _histogram(sessions, "visit_length", VISIT_BUCKETS)


def step_length_histogram(sessions: DataFrame) -> DataFrame:
    """Sessions per step bucket; an empty bucket has no row."""
    return _histogram(sessions, "step_length", STEP_BUCKETS)


def session_stat_ratio(sessions: DataFrame, task_id: str) -> DataFrame:
    """One row: the session count and each bucket's share of it.

    All counts come from one global aggregate, so each task sends a single row.
    """
    shares = [
        ratio(f"count_if({_in_bucket(column, low, high)})", "count(*)") + f" as {column}_{name}_ratio"
        for column, buckets in (("visit_length", VISIT_BUCKETS), ("step_length", STEP_BUCKETS))
        for name, low, high in buckets
    ]
    stats = sessions.selectExpr("count(*) as session_count", *shares)
    return stats.withColumn("taskid", F.lit(task_id)).select(RATIOS.names)
