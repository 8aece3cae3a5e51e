"""Joins without a broadcast, where one user or one session has a third of the rows."""

import re

from conftest import settings
from visitlens.operators.rankings import category_counts
from visitlens.operators.sessions import filtered_sessions
from visitlens.params import TaskParams

ALL = TaskParams("2024-01-01", "2024-01-31")

# A cluster's defaults, scaled down to some kilobytes.
TIGHT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
}


def collected(df):
    rows = sorted((tuple(row) for row in df.collect()), key=repr)
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_hot_user_is_split(spark, crowded_actions, users):
    wide = crowded_actions.selectExpr("*", "explode(sequence(1, 12)) as copy").selectExpr(
        "concat(session_id, '-', copy) as session_id", "* except (session_id, copy)"
    )

    def build():
        return filtered_sessions(wide, users, ALL).select("session_id", "age", "step_length")

    expected, _ = collected(build())
    with settings(spark, TIGHT):
        found, plan = collected(build())
    assert found == expected
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_session_is_split(spark, crowded_actions, users):
    def build():
        return category_counts(crowded_actions, filtered_sessions(crowded_actions, users, ALL))

    expected, _ = collected(build())
    with settings(spark, TIGHT):
        found, plan = collected(build())
    assert found == expected
    assert re.search(r"SortMergeJoin\(skew=true\).*LeftSemi", plan) and "Broadcast" not in plan
