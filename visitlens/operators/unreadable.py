"""Counts of values that cannot be read.

One policy holds everywhere: such a value is treated as a missing one, and counted here. An
action without a readable time counts as a step of its session but gives it no start or end
and is no visit of a page. Ids in a set that are no whole numbers name no category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.functions.times import parse_time


def _bad_ids(ids: str) -> str:
    return f"size(filter(split({ids}, ','), id -> try_cast(id as bigint) is null))"


def unreadable_values(actions: DataFrame) -> DataFrame:
    """One row: actions, those without a readable time, and ids in order and payment sets that
    are no whole numbers. One scan, combined in tasks."""
    return actions.agg(
        F.expr("count(*) as actions"),
        F.expr(f"count_if({parse_time('action_time')} is null) as times"),
        F.expr(f"coalesce(sum({_bad_ids('order_category_ids')}), 0) as order_ids"),
        F.expr(f"coalesce(sum({_bad_ids('pay_category_ids')}), 0) as pay_ids"),
    )
