"""Visits by inactivity: a user's actions cut where nothing happens for a while.

An extension of ours: the reference takes sessions as they are given with the actions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.functions.times import parse_time

GAP_SECONDS = 1800


def visits(actions: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """user_id, ``visit`` (from 1), first_second and last_second (of the epoch) and ``actions`` per visit.

    Two neighbouring actions of a user are of one visit if less than ``gap_seconds`` lie between them. Actions
    without a user or a readable time are of none.

    Actions are first merged by user and stretch of ``gap_seconds``, combined in tasks, to the first and last
    second of each of the stretch's two halves: less than the gap lies between any two actions of one half, and
    between halves the ends decide. So a user with a third of all actions is at most two rows per stretch and task in the
    shuffle, however many actions there are, and the window below is over stretches.
    """
    if gap_seconds < 2:
        raise ValueError("a gap needs at least two seconds")
    half = gap_seconds // 2
    seconds = f"unix_seconds({parse_time('action_time')})"
    merged = (
        actions.where("user_id >= 0")
        .selectExpr("user_id", f"{seconds} as second")
        .selectExpr("user_id", "second", f"cast(floor(second / {half}) as bigint) as part")
        .groupBy("user_id", "part")
        # Unreadable times are one group per user, counted 0: a filter on them would parse each time twice.
        .agg(F.min("second").alias("low"), F.max("second").alias("high"), F.count("second").alias("n"))
        .where("n > 0")
    )
    in_order = "over (partition by user_id order by low)"
    cut = merged.selectExpr("*", f"coalesce(low - lag(high) {in_order} >= {gap_seconds}, true) as new")
    numbered = cut.selectExpr("*", f"count_if(new) {in_order} as visit")
    return numbered.groupBy("user_id", "visit").agg(
        F.min("low").alias("first_second"), F.max("high").alias("last_second"), F.sum("n").alias("actions")
    )
