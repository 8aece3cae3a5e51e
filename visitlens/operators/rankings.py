"""Top categories, and the top sessions in each.

The inputs declare these outputs without a computation; the definitions are ours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.schemas import NO_CLICK, TOP10_CATEGORY, TOP10_SESSION

# Fixed value: rows kept per ranking.
TOP = 10


def category_counts(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Clicks, orders and payments per category, over the actions of the given sessions.

    Only actions that name a category are joined, unexploded, and the counting after
    the join combines within tasks. Neither the join nor the count needs a session in
    one place, so Spark's skew join can split a hot session between tasks. Text in an
    id set that is no whole number is no category id and is not counted.
    """
    named = actions.selectExpr(
        "session_id",
        f"cast(nullif(click_category_id, {NO_CLICK}) as string) as click",
        "order_category_ids as order",
        "pay_category_ids as pay",
    ).where("coalesce(click, order, pay) is not null")
    return (
        named.join(sessions.select("session_id"), "session_id", "left_semi")
        .unpivot([], ["click", "order", "pay"], "kind", "ids")
        .where("ids is not null")
        .selectExpr("kind", "explode(split(ids, ',')) as id")
        .selectExpr("kind", "try_cast(id as bigint) as category_id")
        .where("category_id is not null")
        .groupBy("category_id")
        .agg(
            F.expr("count_if(kind = 'click') as clicks"),
            F.expr("count_if(kind = 'order') as orders"),
            F.expr("count_if(kind = 'pay') as pays"),
        )
    )


def top_categories(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """The leading categories by clicks, then orders, then payments, then id."""
    return (
        category_counts(actions, sessions)
        .orderBy("clicks", "orders", "pays", "category_id", ascending=[False, False, False, True])
        .limit(TOP)
    )


def top10_category(best: DataFrame, task_id: str) -> DataFrame:
    """The outward form of ``top_categories``."""
    return best.select(
        F.lit(task_id).alias("taskid"),
        F.expr("category_id as categoryid"),
        F.expr("clicks as clickCount"),
        F.expr("orders as orderCount"),
        F.expr("pays as payCount"),
    ).select(TOP10_CATEGORY.names)


def top10_session(
    actions: DataFrame, sessions: DataFrame, best: DataFrame, task_id: str
) -> DataFrame:
    """Per category of ``best``, the sessions that clicked it most.

    ``best`` holds at most ``TOP`` rows, which makes the broadcast safe; only clicks on
    those categories leave the scan. The constant bound on the rank lets each task keep
    only its own best rows before the shuffle, so a category clicked by a third of all
    sessions is never sorted in one task.
    """
    clicks = (
        actions.selectExpr("session_id", f"nullif(click_category_id, {NO_CLICK}) as category_id")
        .join(F.broadcast(best.select("category_id")), "category_id", "left_semi")
        .groupBy("session_id", "category_id")
        .agg(F.expr("count(*) as clicks"))
        .join(sessions.select("session_id"), "session_id", "left_semi")
    )
    rank = "row_number() over (partition by category_id order by clicks desc, session_id)"
    return (
        clicks.selectExpr("*", f"{rank} as rank")
        .where(f"rank <= {TOP}")
        .select(
            F.lit(task_id).alias("taskid"),
            F.expr("category_id as categoryid"),
            F.expr("session_id as sessionid"),
            F.expr("clicks as clickCount"),
        )
        .select(TOP10_SESSION.names)
    )
