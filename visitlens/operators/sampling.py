"""A repeatable sample of sessions, spread over dates and hours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.functions.times import format_time
from visitlens.operators.sessions import JOINED_VALUES, value_lists, with_values
from visitlens.schemas import RANDOM_EXTRACT, SESSION_DETAIL

# Fixed value: sessions drawn per task.
SAMPLE_SIZE = 100


def _by_hour(sessions: DataFrame) -> DataFrame:
    """Sessions by start; one without any readable time belongs to no hour."""
    return sessions.selectExpr(
        "session_id", "start_ts", "to_date(start_ts) as date", "hour(start_ts) as hour"
    ).where("start_ts is not null")


def hourly_counts(sessions: DataFrame) -> DataFrame:
    """Sessions per start hour, per start date, and the number of dates.

    Only the hourly counts are brought together to number the dates: at most 24 per
    calendar day, however many sessions there are.
    """
    per_hour = _by_hour(sessions).groupBy("date", "hour").agg(F.expr("count(*) as hour_count"))
    return (
        per_hour.agg(
            F.expr("collect_list(struct(date, hour, hour_count)) as hours"),
            F.expr("size(collect_set(date)) as n_dates"),
        )
        .selectExpr("n_dates", "inline(hours)")
        .selectExpr(
            "date",
            "hour",
            "hour_count",
            "sum(hour_count) over (partition by date) as date_count",
            "n_dates",
        )
    )


def sample_quota(sessions: DataFrame, size: int = SAMPLE_SIZE) -> DataFrame:
    """How many sessions to draw from each hour.

    Every date gets ``size div n_dates``; an hour gets its share of that, truncated,
    never more than it has. Quotas therefore add up to ``size`` at most, and to 0
    when there are more dates than ``size``.
    """
    share = f"floor(hour_count / date_count * ({int(size)} div n_dates))"
    return hourly_counts(sessions).selectExpr("*", f"least({share}, hour_count) as quota")


def draw_sessions(sessions: DataFrame, seed: str, size: int = SAMPLE_SIZE) -> DataFrame:
    """The first ``quota`` sessions of every hour, in the order of a seeded hash.

    No quota exceeds ``size``, so that bound on the rank changes nothing
    in the result, but it lets Spark cut each hour to that many rows per task before
    the shuffle. A crowded hour is never brought together whole. The hash makes the
    draw repeatable, also when a lost executor's part of it is computed again.
    """
    shuffled = Window.partitionBy("date", "hour").orderBy(
        F.md5(F.concat_ws("|", F.col("session_id"), F.lit(seed))), "session_id"
    )
    candidates = (
        _by_hour(sessions)
        .withColumn("rank", F.row_number().over(shuffled))
        .where(F.col("rank") <= int(size))
    )
    quota = sample_quota(sessions, size).select("date", "hour", "quota")
    return (
        candidates.join(quota, ["date", "hour"])
        .where(F.col("rank") <= F.col("quota"))
        .select("session_id", "start_ts", "rank")
    )


def actions_of(actions: DataFrame, drawn: DataFrame) -> DataFrame:
    """Actions of the drawn sessions.

    The quotas add up to the sample size at most, so broadcasting ``drawn`` is safe at
    any scale, and the actions are filtered where they are read. Both outputs of the sample
    come from these rows; a job writes them once.
    """
    return actions.join(F.broadcast(drawn.select("session_id")), "session_id", "left_semi")


def random_extract(drawn_actions: DataFrame, drawn: DataFrame, task_id: str) -> DataFrame:
    """The drawn sessions with their keywords and clicked categories, from ``actions_of``.

    A session that two profiles brought into the draw twice is in it twice.
    """
    lists = value_lists(drawn_actions, ["session_id"])
    extract = with_values(drawn, lists, ["session_id"]).selectExpr(
        "session_id as sessionid", f"{format_time('start_ts')} as startTime", *JOINED_VALUES
    )
    return extract.withColumn("taskid", F.lit(task_id)).select(RANDOM_EXTRACT.names)


def session_detail(drawn_actions: DataFrame, task_id: str) -> DataFrame:
    """Every action of the drawn sessions, from ``actions_of``."""
    detail = drawn_actions.selectExpr(
        "user_id as userid",
        "session_id as sessionid",
        "page_id as pageid",
        "action_time as actionTime",
        "search_keyword as searchKeyword",
        "click_category_id as clickCategoryId",
        "click_product_id as clickProductId",
        "order_category_ids as orderCategoryIds",
        "order_product_ids as orderProductIds",
        "pay_category_ids as payCategoryIds",
        "pay_product_ids as payProductIds",
    )
    return detail.withColumn("taskid", F.lit(task_id)).select(SESSION_DETAIL.names)
