import pytest

from brute import convert_rates
from conftest import action
from visitlens.operators.conversion import page_convert_rate
from visitlens.schemas import ACTIONS


@pytest.mark.parametrize("flow", [(1, 2, 3, 4), (5, 0), (2, 2, 4, 1, 1), (3, 99, 3)])
def test_matches_brute_force(crowded, crowded_actions, flow):
    found = page_convert_rate(crowded_actions, flow, "t")
    assert found.columns == ["taskid", "page_split", "convert_rate"]
    rows = found.collect()
    assert {r.page_split: r.convert_rate for r in rows} == convert_rates(crowded, flow)
    assert len(rows) == len(flow) - 1


def test_a_flow_needs_two_pages(crowded_actions):
    with pytest.raises(ValueError, match="two pages"):
        page_convert_rate(crowded_actions, (1,), "t")


def test_no_actions(crowded_actions):
    rows = page_convert_rate(crowded_actions.where("false"), (1, 2), "t").collect()
    assert [tuple(r) for r in rows] == [("t", "1_2", 0.0)]


def test_moves_over_hours_days_and_1970(spark):
    times = [
        "1969-12-30 7:00:00",
        "1969-12-31 23:59:59",
        "1970-01-01 0:00:00",
        "1970-01-01 0:59:59",
        "1970-01-01 1:00:00",
        "1970-01-01 1:00:00",
        "1970-01-01 1:00:00",
        "1970-01-03 5:00:00",
    ]
    rows = [action("s", time, page=1 + i % 4) for i, time in enumerate(times)]
    rows += [action("t", times[2], page=1), action("t", times[7], page=9)]
    found = page_convert_rate(spark.createDataFrame(rows, ACTIONS), (1, 2, 3, 4, 1, 9), "t").collect()
    assert {r.page_split: r.convert_rate for r in found} == convert_rates(rows, (1, 2, 3, 4, 1, 9))


def test_times_that_cannot_be_read_are_no_visits(spark):
    rows = [
        action("s", "2024-01-01 1:00:00", page=1),
        action("s", None, page=1, date="2024-01-01"),
        action("s", "2024-01-01 25:00:00", page=1, date="2024-01-01"),
        action("s", "2024-01-01 1:00:01", page=2),
    ]
    found = page_convert_rate(spark.createDataFrame(rows, ACTIONS), (1, 2), "t").collect()
    assert [(r.page_split, r.convert_rate) for r in found] == [("1_2", 1.0)]


def test_actions_are_counted_by_hash_before_the_first_shuffle(spark, crowded_actions):
    found = page_convert_rate(crowded_actions, (1, 2, 3), "t")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "collect" not in plan
    assert "partial_count" in plan
