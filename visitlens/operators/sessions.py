"""Actions to sessions, and sessions to their users' profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.functions.times import format_time, parse_time, seconds_between
from visitlens.operators.filters import (
    behaviour_flags,
    in_date_range,
    session_predicate,
)
from visitlens.params import TaskParams
from visitlens.schemas import NO_CLICK, NO_USER

PROFILE = ["age", "professional", "sex", "city"]

# What an action says about its session; null where it says nothing.
KEYWORD = "nullif(search_keyword, '')"
CATEGORY = f"nullif(click_category_id, {NO_CLICK})"
USER = f"nullif(user_id, {NO_USER})"
WHEN = parse_time("action_time")

VALUE_LISTS = {"search_keywords": "array<string>", "click_category_ids": "array<bigint>"}

# The value lists as comma-separated text.
JOINED_VALUES = [
    "array_join(search_keywords, ',') as searchKeywords",
    "array_join(cast(click_category_ids as array<string>), ',') as clickCategoryIds",
]


def session_totals(actions: DataFrame, params: TaskParams) -> DataFrame:
    """One row of fixed-width values per session, plus a flag per behaviour filter.

    All buffers have a fixed width, so this is one hash aggregation with a partial
    step before the only shuffle: a session with a third of all rows reaches its
    final task as one row per map task. Keyword and category filters are decided
    here by flags; no set of values is built to test them.
    """
    sessions = actions.groupBy("session_id").agg(
        F.expr(f"coalesce(min({USER}), {NO_USER}) as user_id"),
        F.expr(f"min({WHEN}) as start_ts"),
        F.expr(f"max({WHEN}) as end_ts"),
        F.expr("count(*) as step_length"),
        *behaviour_flags(params, F.expr(KEYWORD), F.expr(CATEGORY)),
    )
    return sessions.withColumn("visit_length", F.expr(seconds_between("start_ts", "end_ts"))).drop("end_ts")


def value_lists(actions: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct keywords and clicked categories per key, sorted, for keys that have any.

    Only actions that name one take part. The first step is a hash aggregation by key and
    value: a key that is everywhere is split by its values, whatever the partitions, and
    reaches the list step as one row per distinct pair.
    """
    named = actions.selectExpr(*keys, f"{KEYWORD} as keyword", f"{CATEGORY} as category_id").where(
        "coalesce(keyword, cast(category_id as string)) is not null"
    )
    distinct = named.groupBy(*keys, "keyword", "category_id").agg(F.expr("count(*) as n"))
    return distinct.groupBy(*keys).agg(
        F.expr("sort_array(array_distinct(collect_list(keyword))) as search_keywords"),
        F.expr("sort_array(array_distinct(collect_list(category_id))) as click_category_ids"),
    )


def with_values(sessions: DataFrame, lists: DataFrame, keys: list[str]) -> DataFrame:
    """Sessions with their value lists, empty where there are none."""
    return sessions.join(lists, keys, "left").withColumns(
        {name: F.coalesce(name, F.array().cast(kind)) for name, kind in VALUE_LISTS.items()}
    )


def with_profiles(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Inner join on the user. A session without a profile is dropped, one with two appears twice.

    No join hint: the profiles grow with the data, so Spark broadcasts them only when
    their measured size allows it and otherwise splits a hot user with its skew join.
    """
    return sessions.join(users.select("user_id", *PROFILE), "user_id", "inner")


def filtered_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions of the date range that pass every filter, without their value lists."""
    sessions = session_totals(in_date_range(actions, params), params)
    return with_profiles(sessions, users).where(session_predicate(params))


def filtered_records(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions of the date range that pass every filter, with their value lists.

    Lists are built for the sessions that passed only, and joined to them.
    """
    sessions = filtered_sessions(actions, users, params)
    passed = in_date_range(actions, params).join(sessions.select("session_id"), "session_id", "left_semi")
    return with_values(sessions, value_lists(passed, ["session_id"]), ["session_id"])


def as_session_record(records: DataFrame) -> DataFrame:
    """The outward form of a session record."""
    return records.selectExpr(
        "session_id as sessionid",
        *JOINED_VALUES,
        "visit_length as visitLength",
        "step_length as stepLength",
        f"{format_time('start_ts')} as startTime",
        *PROFILE,
    )
