"""Visits by inactivity against brute force."""

import datetime
import random

import pytest

from conftest import action
from visitlens.operators.visits import visits
from visitlens.schemas import ACTIONS


def brute(rows, gap):
    """``rows``: user, second."""
    found = []
    for user in {u for u, _ in rows}:
        visit, last = 0, None
        for second in sorted(s for u, s in rows if u == user):
            if last is None or second - last >= gap:
                visit += 1
                found.append([user, visit, second, second, 0])
            last = second
            found[-1][3:] = [second, found[-1][4] + 1]
    return sorted(map(tuple, found))


def given(spark, rows, more=()):
    start = datetime.datetime(1969, 12, 31, 20)
    epoch = datetime.datetime(1970, 1, 1)
    actions = [action("s", str(start + datetime.timedelta(seconds=s)), user=u) for u, s in rows]
    offset = int((start - epoch).total_seconds())
    return spark.createDataFrame([*actions, *more], ACTIONS).repartition(4), [(u, s + offset) for u, s in rows]


@pytest.mark.parametrize("gap", [2, 3, 60, 61, 1800])
def test_matches_brute_force(spark, gap):
    rng = random.Random(gap)
    rows = []
    for user in range(6):
        second = rng.randrange(3 * gap)
        for _ in range(60):
            second += rng.choice([0, 1, gap // 2, gap - 1, gap, gap + 1, 4 * gap])
            rows.append((user, second))
    # A user with half of all actions, without any gap.
    rows += [(9, rng.randrange(6000)) for _ in range(400)]
    more = [action("s", "1970-01-01 0:00:00", user=-1), action("s", "1970-01-01 25:00:00", user=1), action("s", None, user=2, date="x")]
    actions, seconds = given(spark, rows, more)
    found = visits(actions, gap)
    assert found.columns == ["user_id", "visit", "first_second", "last_second", "actions"]
    assert sorted(map(tuple, found.collect())) == brute(seconds, gap)


def test_a_hot_user_is_merged_in_tasks(spark):
    actions, _ = given(spark, [(1, i % 900) for i in range(3000)])
    found = visits(actions, 1800)
    assert [r.actions for r in found.collect()] == [3000]
    assert "partial_min" in found._jdf.queryExecution().executedPlan().toString()
    assert visits(actions.where("false")).collect() == []
    with pytest.raises(ValueError, match="two seconds"):
        visits(actions, 1)
