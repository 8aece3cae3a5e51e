"""Page-to-page conversion along a flow of pages.

Only the parameter for this is declared with the inputs; the definition is ours.
"""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.functions.times import parse_time
from visitlens.functions.values import ratio


def _slot(pages: list[int]) -> str:
    """Place of ``page_id`` among the sorted flow pages: odd on a page, even between two.

    Pages outside the flow that lie between the same two flow pages share a slot. They
    cannot take part in a conversion, and sharing keeps their order against flow pages.
    Each flow page adds one for pages from it on and one for pages beyond it; all terms read one
    ``page_id``, which is computed once. An action without a page is like one of the last slot.
    """
    terms = " + ".join(f"int(page_id >= {page}) + int(page_id > {page})" for page in pages)
    return f"coalesce({terms}, {2 * len(pages)})"


def page_convert_rate(actions: DataFrame, flow: tuple[int, ...], task_id: str) -> DataFrame:
    """Per neighbouring pair (a, b) of the flow: moves from a straight to b / visits of a.

    A session's actions are ordered by time and, within a second, by page; a ``tick`` is
    that order as one number. Actions are counted per session and tick, by hash and
    combined in tasks, so a crowded hour is split by its ticks. Equal ticks of a session
    are adjacent: n of them make n - 1 moves from the page to itself, and the tick moves on
    to the session's next one. Next ticks are found within an hour, which has at most 3600
    seconds times the slots of the flow. Hours are aggregated to their first and last tick, combined in
    tasks, and an hour's last one is tied to the first of the session's next hour by a window over
    these few rows. Both read one exchange of the counts, so the actions are scanned once. An action
    without a readable time is no visit.
    """
    if len(flow) < 2:
        raise ValueError("a page flow needs at least two pages")
    pages = sorted(set(flow))
    slots = 2 * len(pages) + 1
    tick = f"unix_seconds({parse_time('action_time')}) * {slots} + {_slot(pages)}"
    # Unreadable times are one group per session, counted 0: a filter on the tick would parse each time twice.
    ticks = (
        actions.selectExpr("session_id", f"{tick} as tick")
        .groupBy("session_id", "tick")
        .agg(F.expr("count(tick) as n"))
        .where("n > 0")
        .withColumn("hour", F.expr(f"tick div {3600 * slots}"))
    )
    in_hour = "over (partition by session_id, hour order by tick)"
    inside = ticks.selectExpr("tick", "n as visits", "n - 1 as stays", f"lead(tick) {in_hour} as next_tick")
    hours = ticks.groupBy("session_id", "hour").agg(F.min("tick").alias("first_tick"), F.max("tick").alias("last_tick"))
    # The visits of an hour's last tick are counted with the others.
    over = hours.selectExpr(
        "last_tick as tick",
        "0L as visits",
        "0L as stays",
        "lead(first_tick) over (partition by session_id order by hour) as next_tick",
    ).where("next_tick is not null")
    counts = (
        inside.unionByName(over)
        .groupBy(
            F.expr(f"pmod(tick, {slots}) as slot"), F.expr(f"pmod(next_tick, {slots}) as next_slot")
        )
        .agg(F.sum("visits").alias("visits"), F.sum("stays").alias("stays"), F.count("next_tick").alias("moves"))
    )
    slot_of = {page: 2 * i + 1 for i, page in enumerate(pages)}
    rates = ", ".join(
        f"struct('{a}_{b}' as page_split, {_rate(slot_of[a], slot_of[b])} as convert_rate)"
        for a, b in pairwise(flow)
    )
    return (
        counts.selectExpr(f"array({rates}) as rates")
        .selectExpr("inline(rates)")
        .withColumn("taskid", F.lit(task_id))
        .select("taskid", "page_split", "convert_rate")
    )


def _rate(a: int, b: int) -> str:
    visits = f"coalesce(sum(visits) filter (where slot = {a}), 0)"
    moved = f"coalesce(sum(moves) filter (where slot = {a} and next_slot = {b}), 0)"
    if a == b:
        moved += f" + coalesce(sum(stays) filter (where slot = {a}), 0)"
    return ratio(f"({moved})", visits)
