"""Named queries over the given test tables, one per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions import times, values
from visitlens.operators import (
    conversion,
    histograms,
    products,
    rankings,
    sampling,
    sessions,
    unreadable,
    visits,
)
from visitlens.operators.filters import in_date_range
from visitlens.params import TaskParams
from visitlens.sinks.shared import shared_folder, written
from visitlens.sinks.tables import replace_table
from visitlens.sources import driver_tables as tables
from visitlens.streaming import ad_clicks, ad_reports

TASK_ID = "task-1"
SEED = "7"

# Clicks of a user on one ad in a day.
AD_LIMIT = 3

DATES = TaskParams(start_date="2024-01-01", end_date="2024-01-04")
TASK = replace(DATES, start_age=20, end_age=50, target_page_flow=(1, 2, 3, 4, 5, 6, 7))

# One task per filter, then all of them together.
FILTERS = {
    "filter_age": replace(DATES, start_age=20, end_age=50),
    "filter_professional": replace(DATES, professionals=("BUILDING", "MACHINERY")),
    "filter_city": replace(DATES, cities=("NATION_1", "NATION_5", "NATION_12")),
    "filter_sex": replace(DATES, sex="male"),
    "filter_keywords": replace(DATES, keywords=("kw1", "kw5")),
    "filter_categories": replace(DATES, category_ids=(3, 7, 42)),
    "filter_all": replace(
        DATES,
        start_age=10,
        end_age=55,
        professionals=("BUILDING", "MACHINERY", "HOUSEHOLD"),
        cities=tuple(f"NATION_{i}" for i in range(0, 25, 2)),
        sex="male",
        keywords=("kw1", "kw5", "kw9", "kw13"),
        category_ids=tuple(range(0, 100, 4)),
    ),
}

Query = Callable[[SparkSession, str], DataFrame]


def _actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_date_range(tables.actions(spark, sf_dir), TASK)


def _actions_and_sessions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    actions = _actions(spark, sf_dir)
    return actions, sessions.filtered_sessions(actions, tables.users(spark, sf_dir), TASK)


def _records(params: TaskParams) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        records = sessions.filtered_records(
            tables.actions(spark, sf_dir), tables.users(spark, sf_dir), params
        )
        return sessions.as_session_record(records)

    return query


def _over_sessions(operator: Callable[..., DataFrame], *args) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        _, found = _actions_and_sessions(spark, sf_dir)
        return operator(found, *args)

    return query


def _drawn(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    actions, found = _actions_and_sessions(spark, sf_dir)
    drawn = sampling.draw_sessions(found, SEED)
    return sampling.actions_of(actions, drawn), drawn


def _random_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.random_extract(*_drawn(spark, sf_dir), TASK_ID)


def _session_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.session_detail(_drawn(spark, sf_dir)[0], TASK_ID)


def _top10_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions, found = _actions_and_sessions(spark, sf_dir)
    return rankings.top10_category(rankings.top_categories(actions, found), TASK_ID)


def _top10_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions, found = _actions_and_sessions(spark, sf_dir)
    best = rankings.top_categories(actions, found)
    return rankings.top10_session(actions, found, best, TASK_ID)


def _sessions_per_hour(found: DataFrame) -> DataFrame:
    return sampling.hourly_counts(found).withColumn("date", F.col("date").cast("string"))


def _sample_quota(found: DataFrame) -> DataFrame:
    return sampling.sample_quota(found).selectExpr(
        "cast(date as string) as date", "hour", "hour_count", "quota"
    )


def _time_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, day = times.parse_time("action_time"), times.parse_time("date")
    ten = "concat(date, ' 10:00:00')"
    expressions = {
        "session_id": "session_id",
        "action_time": "action_time",
        "before_ten": times.before("action_time", ten),
        "after_ten": times.after("action_time", ten),
        "second_of_day": times.seconds_between(day, ts),
        "date_hour": times.date_hour(ts),
        "day": times.format_date(ts),
        "date_key": times.date_key(ts),
        "minute_key": times.minute_key(ts),
        "time": times.format_time(ts),
        "day_of_key": times.format_date(times.parse_date_key(times.date_key(ts))),
        "today": times.today(),
        "days_from_yesterday": f"datediff({times.today()}, {times.yesterday()})",
        "no_keyword": values.is_empty("search_keyword"),
        "has_keyword": values.is_not_empty("search_keyword"),
        "page_eighths": values.half_up("page_id / 8", 2),
        # One or two commas in front, none or one behind; texts of no to three characters.
        "trimmed": values.trim_comma("concat(if(page_id < 5, ',,', ','), session_id, if(page_id % 2 = 0, ',', ''))"),
        "two_digits": values.two_digits("substring(cast(1000 + page_id * 37 as string), 2, cast(page_id % 4 as int))"),
    }
    return tables.actions(spark, sf_dir).selectExpr(
        *[f"{expression} as {name}" for name, expression in expressions.items()]
    )


def _click_columns(clicks: DataFrame) -> DataFrame:
    return clicks.selectExpr("unix_millis(ts) as millis", "province", "city", "user_id", "ad_id")


def _ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.ad_lines(tables.events(spark, sf_dir))
    return _click_columns(ad_clicks.parse_ad_lines(lines))


def _rejected_ad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_clicks.rejected_ad_lines(tables.ad_lines(tables.events(spark, sf_dir)))


def _unreadable_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of actions some of whose times and order ids are spoilt on purpose."""
    return unreadable.unreadable_values(
        tables.actions(spark, sf_dir).withColumns(
            {
                "action_time": F.expr("if(page_id = 3, concat(action_time, 'x'), action_time)"),
                "order_category_ids": F.expr("if(page_id < 2, concat(order_category_ids, ',x'), order_category_ids)"),
            }
        )
    )


def _table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profiles as a catalog table holds them after it was replaced."""
    table = f"round_trip_{uuid.uuid4().hex}"
    users = tables.users(spark, sf_dir)
    replace_table(users.select("user_id", "name"), table)
    replace_table(users, table, partition_by="sex")
    try:
        return written(spark.table(table).select(users.columns), shared_folder(spark))
    finally:
        spark.sql(f"DROP TABLE {table}")


def _ad_click_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same clicks through a streaming query and its Parquet sink."""
    lines = tables.ad_lines(tables.event_stream(spark, sf_dir))
    clicks = ad_clicks.parse_ad_lines(lines)
    folder = shared_folder(spark)
    ad_clicks.append_to_folder(clicks, f"{folder}/clicks", f"{folder}/progress").awaitTermination()
    return _click_columns(spark.read.schema(clicks.schema).parquet(f"{folder}/clicks"))


def _sent_again(events: DataFrame) -> DataFrame:
    """Every seventh event twice, as a producer sends it that does not know it arrived."""
    return events.withColumn("sent", F.expr("explode(if(event_id % 7 = 0, array(1, 2), array(1)))")).drop("sent")


def _ad_clicks_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = ad_clicks.parse_ad_lines(tables.ad_lines(tables.event_stream(spark, sf_dir)))
    counted = ad_reports.clicks_per_window(clicks)
    folder = shared_folder(spark)
    ad_reports.changes_to_folder(counted, f"{folder}/counts", f"{folder}/progress").awaitTermination()
    keys = [name for name in counted.columns if name != "clicks"]
    found = ad_reports.latest(spark, f"{folder}/counts", counted.schema, keys)
    return found.selectExpr("unix_millis(window_start) as window_millis", "province", "city", "ad_id", "clicks")


def _distinct_ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = ad_clicks.parse_ad_lines(tables.ad_lines(_sent_again(tables.event_stream(spark, sf_dir))))
    folder = shared_folder(spark)
    ad_clicks.append_to_folder(ad_reports.first_clicks(clicks), f"{folder}/clicks", f"{folder}/progress").awaitTermination()
    return _click_columns(spark.read.schema(clicks.schema).parquet(f"{folder}/clicks"))


def _limit_columns(reached: DataFrame) -> DataFrame:
    return reached.selectExpr("user_id", "ad_id", "cast(day as string) as day", "unix_millis(reached_at) as reached_millis")


def _ad_users_over_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = ad_clicks.parse_ad_lines(tables.ad_lines(tables.events(spark, sf_dir)))
    return _limit_columns(ad_reports.over_limit(clicks, AD_LIMIT))


def _ad_users_over_limit_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = ad_clicks.parse_ad_lines(tables.ad_lines(tables.event_stream(spark, sf_dir)))
    folder = shared_folder(spark)
    with ad_reports.state_store(spark):
        reached = ad_reports.over_limit_stream(clicks, AD_LIMIT)
        ad_clicks.append_to_folder(reached, f"{folder}/reached", f"{folder}/progress").awaitTermination()
    return _limit_columns(spark.read.schema(reached.schema).parquet(f"{folder}/reached"))


def all_queries() -> dict[str, Query]:
    return {
        "actions_in_range": _actions,
        "user_profiles": tables.users,
        "session_full_info": _records(DATES),
        **{name: _records(params) for name, params in FILTERS.items()},
        "visit_length_histogram": _over_sessions(histograms.visit_length_histogram),
        "step_length_histogram": _over_sessions(histograms.step_length_histogram),
        "session_stat_ratio": _over_sessions(histograms.session_stat_ratio, TASK_ID),
        "sessions_per_hour": _over_sessions(_sessions_per_hour),
        "sample_quota": _over_sessions(_sample_quota),
        "session_random_extract": _random_extract,
        "session_detail": _session_detail,
        "top10_category": _top10_category,
        "top10_session": _top10_session,
        "page_convert_rate": lambda spark, sf_dir: conversion.page_convert_rate(
            _actions(spark, sf_dir), TASK.target_page_flow, TASK_ID
        ),
        "product_status": lambda spark, sf_dir: products.product_status(
            tables.products(spark, sf_dir)
        ),
        "time_keys": _time_keys,
        "ad_clicks": _ad_clicks,
        "ad_click_stream": _ad_click_stream,
        "rejected_ad_lines": _rejected_ad_lines,
        "unreadable_values": _unreadable_values,
        "table_round_trip": _table_round_trip,
        # Extensions of ours.
        "visits_by_inactivity": lambda spark, sf_dir: visits.visits(tables.actions(spark, sf_dir)),
        "ad_clicks_per_window": _ad_clicks_per_window,
        "distinct_ad_clicks": _distinct_ad_clicks,
        "ad_users_over_limit": _ad_users_over_limit,
        "ad_users_over_limit_stream": _ad_users_over_limit_stream,
    }
