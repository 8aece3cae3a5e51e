"""The input tables derived from the given test tables (FIXTURES.md §3).

The test events carry no session id. Blocks of 127 consecutive events are cut into
seven sessions of 1, 2, 4, ... 64 actions, with 1, 5 or 30 seconds between actions.
Everything is integer and text arithmetic, so any SQL engine derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EVENTS = "event_id bigint, user_id bigint, event_type string, props string"
CUSTOMERS = "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string"
NATIONS = "n_nationkey int, n_name string"
PARTS = "p_partkey bigint, p_name string"


def _read(spark: SparkSession, sf_dir: str, table: str, columns: str) -> DataFrame:
    return spark.read.schema(columns).parquet(f"{sf_dir}/{table}.parquet")


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_visit_action`` from the events."""
    placed = (
        _read(spark, sf_dir, "events", EVENTS)
        .selectExpr(
            "event_id",
            "event_type",
            "cast(get_json_object(props, '$.k') as bigint) as k",
            "event_id div 127 as blk",
            "event_id % 127 as pos",
        )
        .selectExpr(
            "*",
            # Session in the block, its first position, and the seconds between its actions.
            """case when pos < 1 then 0 when pos < 3 then 1 when pos < 7 then 2
                    when pos < 15 then 3 when pos < 31 then 4 when pos < 63 then 5
                    else 6 end as sub""",
            """case when pos < 1 then 0 when pos < 3 then 1 when pos < 7 then 3
                    when pos < 15 then 7 when pos < 31 then 15 when pos < 63 then 31
                    else 63 end as sub0""",
            "case blk % 3 when 0 then 1 when 1 then 5 else 30 end as gap",
        )
        .selectExpr(
            "*",
            "(pos - sub0) * gap as sec",
            "concat('2024-01-0', 1 + blk % 5) as date",
            "cast(event_id % 100 as string) as product",
        )
    )
    return placed.selectExpr(
        "date",
        # One session of 13 names no user, and one of 11 a user without a profile.
        """case when (blk * 7 + sub) % 13 = 12 then -1 when (blk * 7 + sub) % 11 = 10 then 1000000000 + blk
                else (blk * 7 + sub) % 1201 end as user_id""",
        "concat('s', blk, '_', sub) as session_id",
        "(event_id + k) % 10 as page_id",
        """concat(date, ' ',
                  lpad(cast(8 + (blk div 5) % 4 + sec div 3600 as string), 2, '0'), ':',
                  lpad(cast(sec % 3600 div 60 as string), 2, '0'), ':',
                  lpad(cast(sec % 60 as string), 2, '0')) as action_time""",
        "case when event_type = 'view' then concat('kw', k % 20) end as search_keyword",
        "case when event_type = 'click' then k else -1 end as click_category_id",
        "case when event_type = 'click' then event_id % 100 else -1 end as click_product_id",
        """case when event_type = 'signup' then
             case when k % 4 = 0 then concat(k, ',', (k + 1) % 100) else cast(k as string) end
           end as order_category_ids""",
        "case when event_type = 'signup' then product end as order_product_ids",
        "case when event_type = 'purchase' then cast(k as string) end as pay_category_ids",
        "case when event_type = 'purchase' then product end as pay_product_ids",
        "(blk * 7 + sub) % 10 as city_id",
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_info`` from the customers."""
    customers = _read(spark, sf_dir, "customer", CUSTOMERS)
    nations = _read(spark, sf_dir, "nation", NATIONS).withColumnRenamed("n_nationkey", "c_nationkey")
    return customers.join(nations, "c_nationkey").selectExpr(
        "c_custkey as user_id",
        "c_name as username",
        "c_name as name",
        "cast(c_custkey * 7 % 60 as int) as age",
        "c_mktsegment as professional",
        "n_name as city",
        "if(c_custkey % 2 = 0, 'male', 'female') as sex",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``product_info`` from the parts."""
    return _read(spark, sf_dir, "part", PARTS).selectExpr(
        "p_partkey as product_id",
        "p_name as product_name",
        """concat('{"product_status": ', p_partkey % 2, '}') as extend_info""",
    )


def ad_lines(events: DataFrame) -> DataFrame:
    """One ad line per event, streaming or not. Error events give a line that is cut short; of
    the others some have a time too large, a word for a number, or one number more."""
    return events.selectExpr(
        """concat_ws(' ',
             if(event_id % 50 = 7, 9223372036854775807, 1704067200000 + event_id * 1000),
             if(event_id % 50 = 11, 'x', cast(event_id % 10 as string)), event_id % 10, user_id % 100,
             case when event_type <> 'error' then event_id % 20 end,
             case when event_type <> 'error' and event_id % 50 = 13 then 1 end) as value"""
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events", EVENTS)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream; the glob takes a single file as well as a folder."""
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events[.]parquet")
