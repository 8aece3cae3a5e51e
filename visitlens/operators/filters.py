"""Task filters as Column predicates."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.params import TaskParams

KEYWORD_HIT = "keyword_hit"
CATEGORY_HIT = "category_hit"
NEVER_LISTED_HIT = "never_listed_hit"
OTHER_KEYWORD = "other_keyword"

# Fixed value: text that no list filter accepts as a value of its own.
NEVER_LISTED = "-1"


def in_date_range(actions: DataFrame, params: TaskParams) -> DataFrame:
    """Actions whose ``date`` text lies between both dates, inclusive."""
    return actions.where(F.col("date").between(params.start_date, params.end_date))


def age_filter(params: TaskParams) -> list[Column]:
    """Inclusive age range; off unless both bounds are given."""
    if params.start_age is None or params.end_age is None:
        return []
    return [F.col("age").between(params.start_age, params.end_age)]


def listed_filter(column: str, values: tuple[str, ...] | None) -> list[Column]:
    """The column equals one of the values."""
    if values is None:
        return []
    return [F.col(column).isin([value for value in values if value != NEVER_LISTED])]


def sex_filter(params: TaskParams) -> list[Column]:
    return [] if params.sex is None else [F.col("sex") == params.sex]


def behaviour_flags(params: TaskParams, keyword: Column, category: Column) -> list[Column]:
    """One boolean aggregate per test of the behaviour filters, over a session's actions."""
    tests = {}
    if params.keywords is not None:
        tests[KEYWORD_HIT] = keyword.isin([v for v in params.keywords if v != NEVER_LISTED])
        if NEVER_LISTED in params.keywords:
            tests[NEVER_LISTED_HIT] = keyword == NEVER_LISTED
            tests[OTHER_KEYWORD] = keyword != NEVER_LISTED
    if params.category_ids is not None:
        tests[CATEGORY_HIT] = category.isin(list(params.category_ids))
    return [F.coalesce(F.bool_or(test), F.lit(False)).alias(name) for name, test in tests.items()]


def session_predicate(params: TaskParams) -> Column:
    """All active filters together. Those on the profile reach the scan of the users."""
    active = [
        *age_filter(params),
        *listed_filter("professional", params.professionals),
        *listed_filter("city", params.cities),
        *sex_filter(params),
    ]
    if params.keywords is not None:
        hit = F.col(KEYWORD_HIT)
        if NEVER_LISTED in params.keywords:
            # Accepted next to another keyword, never as the session's sole one.
            hit = hit | (F.col(NEVER_LISTED_HIT) & F.col(OTHER_KEYWORD))
        active.append(hit)
    if params.category_ids is not None:
        active.append(F.col(CATEGORY_HIT))
    return reduce(and_, active, F.lit(True))
